"""Run-to-completion file stream for the transaction feed.

New ``transactions_*.txt`` files in the landing folder are read once each
(the stream checkpoint remembers them), typed, split into good rows and
rejects, and appended to the fact in ``foreachBatch``. ``availableNow``
processes everything present and stops, so a scheduler can run it daily.
The fact append skips stored ids, so a replayed micro-batch adds nothing. The
stream's checkpoint lies under the warehouse root by default, so the next
application goes on where the last one ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlake.functions.expr import base_name
from fraudlake.plans import warehouse as W
from fraudlake.plans.daily import load_transactions
from fraudlake.schemas import TRANSACTIONS_RAW
from fraudlake.sources.intake import CORRUPT


def transaction_stream(spark: SparkSession, landing: str, archive: str | None = None,
                       files_per_batch: int | None = None, pattern: str = "transactions_*.txt") -> DataFrame:
    schema = T.StructType(TRANSACTIONS_RAW.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    r = (spark.readStream.schema(schema).option("sep", ";").option("header", True)
         .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
         .option("pathGlobFilter", pattern))
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return r.csv(landing).withColumn("file_name", base_name(F.col("_metadata.file_path")))


def run_intake(spark: SparkSession, wh: W.Warehouse, landing: str, archive: str | None = None,
               checkpoint: str | None = None, on_bad: str = "row", pattern: str = "transactions_*.txt") -> int:
    """Load every new file of the landing folder; returns the batches run."""
    ckpt = checkpoint or wh.path("_stream/transactions")   # the same for every application
    batches = []

    def load(batch: DataFrame, epoch: int) -> None:
        load_transactions(spark, wh, batch, on_bad)     # reads the batch once
        batches.append(epoch)

    q = (transaction_stream(spark, landing, archive, pattern=pattern).writeStream
         .foreachBatch(load).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(batches)
