"""A training-corpus pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet in the shared folder and read again as the next stage's docs. All
stages but the last return rows of ``documents`` unchanged.
"""

from __future__ import annotations

import uuid

from martstar.llm.common import python_workers, table
from martstar.llm.decontaminate import drop_leaks
from martstar.llm.exact_dedup import drop_copies
from martstar.llm.packing import pack
from martstar.llm.simhash_dedup import drop_near_copies
from martstar.llm.toxicity import drop_toxic
from martstar.session import scratch_path
from martstar.tables import delete_path


def toxicity(spark, docs, sf_dir):
    """Documents scored 0.5 or more go; the model learns from the labelled rows of the training folds."""
    python_workers(spark)
    return drop_toxic(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def exact_dedup(spark, docs, sf_dir):
    """Of equal texts the row with the smallest doc_id stays."""
    return drop_copies(docs)


def near_dedup(spark, docs, sf_dir):
    """Of each group of linked SimHash fingerprints the smallest doc_id stays."""
    python_workers(spark)
    return drop_near_copies(docs)


def decontaminate(spark, docs, sf_dir):
    """Documents that hold a benchmark item go."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark, docs, sf_dir):
    """What is left, tokenised and packed into sequences."""
    python_workers(spark)
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

# trained weights, fingerprint components and tokenizers are beyond SQL; see tests/llm/test_pipeline.py
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply all stages to ``documents``; a stage's folder goes once the next one is written."""
    base = scratch_path(spark, f"corpus-{uuid.uuid4().hex}")
    docs, before = table(spark, sf_dir, "documents"), None
    for i, (name, stage) in enumerate(STAGES):
        path = f"{base}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            delete_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
