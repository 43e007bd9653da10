"""Small document tables with the awkward cases every operator must survive."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, words string, fp long, w string"


def table(spark, texts):
    """(doc_id, text) pairs as documents with columns whose names operators use inside."""
    return spark.createDataFrame([(i, t, None, "s", None, "x", "y", 1, "z") for i, t in texts], SCHEMA)


def prose(seed, n, vocabulary=200):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(vocabulary)]
    return " ".join(r.choice(words) for _ in range(n))


def awkward():
    """Nulls, empty and blank texts, repeated rows and ids, ties, a long text."""
    a, b = prose(1, 60), prose(2, 40)
    long = prose(3, 20_000, 3000)
    return [(5, a), (3, a), (9, a.replace(" ", "\t\n", 3)), (3, a), (None, a), (7, b), (8, b + " more"), (11, None),
            (12, ""), (13, "  \n"), (14, "x"), (14, "other text"), (20, long), (21, long), (None, None), (22, "Ünï cödé ß 漢字"),
            (2**60 + 1, "a wide id")]


def stage_rows(texts):
    """Repeated and null ids whose texts differ, in columns that stages use inside."""
    return [(i, t, 10 + n, f"keep{n}") for n, (i, t) in enumerate(texts)]


STAGE_SCHEMA = "doc_id long, text string, r int, sha string"
INNER = ["_rank", "_sha", "_n", "_rows", "_kept", "_copy", "_leak", "doc", "kept", "nth", "n", "first", "th"]


def stage_table(spark, texts):
    """``stage_rows`` with a column for every name that stages use or used inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(stage_rows(texts), STAGE_SCHEMA)
    return df.select("*", *[F.concat(F.lit(f"{c}-"), "sha").alias(c) for c in INNER])


def kept_rows(df, before):
    """(id, text) that stayed; every column must be what it was."""
    assert df.columns == before.columns
    was = {r.sha: r for r in before.collect()}
    rows = df.collect()
    assert all(r == was[r.sha] for r in rows)
    return sorted(((r.doc_id, r.text) for r in rows), key=str)
