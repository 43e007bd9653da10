"""The landing load as Structured Streaming.

``readStream`` picks up new JSON files in the landing directory; every micro-batch
is validated and upserted into the catalog warehouse with the same keyed merge as
the batch load. No streaming state is needed: a late correction rewrites its key,
and a replayed batch is known by its number.
"""

from __future__ import annotations

import datetime as _dt
from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import loads as LO
from ..sources import landing as L
from ..sources.catalog import Warehouse
from ..tables import delete_path


def landing_source(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Both layouts of ``sources.landing`` as one stream."""
    def read(lines: bool) -> DataFrame:
        return (L.json_options(spark.readStream, kind, lines).json(path)
                .withColumn("_file", F.col("_metadata.file_path"))
                .withColumn("_block", F.col("_metadata.file_block_start")))

    run = F.col("_file").rlike(L.RUN_FILE)
    return read(True).where(run).unionByName(read(False).where(~run))


def stream_landing(spark: SparkSession, landing_dir: str, warehouse: Warehouse, checkpoint: str,
                   kind: str = "stocks", once: bool = True, as_of_ts: Optional[_dt.datetime] = None,
                   dow: str = "iso"):
    """Start the stream; with ``once`` it processes what is there and stops
    (``trigger(availableNow=True)``).

    A micro-batch is one version of the warehouse: rejects, new days and the years it
    touches, published together with the number of the batch. Readers see the state
    before or after it. A batch that is replayed after a failure finds its number
    and changes nothing.
    """
    src = landing_source(spark, f"{landing_dir.rstrip('/')}/{kind}", kind)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        if warehouse.applied(kind) >= batch_id:
            return
        ts = as_of_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        # inside a micro-batch the frame is static: positions can be numbered
        records = L.with_volume_text(batch.withColumn("_pos", F.struct(
            F.col("_block").alias("block"), F.monotonically_increasing_id().alias("row"))).drop("_block"))
        # the files are read once; what follows runs in the warehouse's own session
        stage = f"{warehouse.root}/_stream/{kind}-{batch_id}"
        records.write.mode("overwrite").parquet(stage)
        with warehouse.change() as c:
            LO.load_records(c, kind, warehouse.spark.read.parquet(stage), ts, dow)
            c.applied[kind] = batch_id
        delete_path(spark, stage)

    w = src.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="1 minute")
    return w.start()
