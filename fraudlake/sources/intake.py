"""Transaction feed intake: ``;``-separated text with a header row.

Typing never raises: every cast is a ``try_cast`` and a line that fails any
of them goes to the rejects table with a reason. ``on_bad="file"`` keeps the
source system's all-or-nothing behaviour per file, decided before any write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlake.functions.expr import base_name, blank_to_null, parse_amount, parse_ts
from fraudlake.schemas import TRANSACTIONS, TRANSACTIONS_RAW

RAW_COLS = [f.name for f in TRANSACTIONS_RAW.fields]
CORRUPT = "_corrupt_record"


def read_transactions_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Raw lines of one or more daily files, bound by position, plus file name."""
    schema = T.StructType(TRANSACTIONS_RAW.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    df = (spark.read.schema(schema)
          .option("sep", ";").option("header", True).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT)
          .csv(paths))
    return df.withColumn("file_name", base_name(F.col("_metadata.file_path")))


def type_transactions(raw: DataFrame, on_bad: str = "row") -> tuple[DataFrame, DataFrame]:
    """Split raw feed rows into typed good rows and rejects ``(file_name, reason, raw)``."""
    return split_typed(typed_lines(raw), on_bad)


def typed_lines(raw: DataFrame) -> DataFrame:
    """Every feed row typed, with ``file_name``, its ``reason`` to be refused and, if it
    has one, its text ``raw``."""
    typed = raw.select(
        *[c for c in ("file_name",) if c in raw.columns],
        blank_to_null("transaction_id").alias("transaction_id"),
        parse_ts("transaction_date").alias("transaction_date"),
        parse_amount("amount").alias("amount"),
        blank_to_null("card_num").alias("card_num"),
        blank_to_null("oper_type").alias("oper_type"),
        blank_to_null("oper_result").alias("oper_result"),
        blank_to_null("terminal").alias("terminal"),
        (F.col(CORRUPT) if CORRUPT in raw.columns else F.lit(None).cast("string")).alias(CORRUPT),
        F.concat_ws(";", *[F.col(c) for c in RAW_COLS]).alias("raw"),
    )
    reason = (F.when(F.col(CORRUPT).isNotNull(), "malformed line")
               .when(F.col("transaction_id").isNull(), "missing transaction_id")
               .when(F.col("transaction_date").isNull(), "bad transaction_date")
               .when(F.col("amount").isNull(), "bad amount")
               .when(F.col("card_num").isNull(), "missing card_num"))
    typed = typed.withColumn("reason", reason)
    if "file_name" not in typed.columns:
        typed = typed.withColumn("file_name", F.lit(None).cast("string"))
    text = F.when(F.col("reason").isNotNull(), F.coalesce(F.col(CORRUPT), F.col("raw")))
    return typed.select(*[f.name for f in TRANSACTIONS.fields], "file_name", "reason", text.alias("raw"))


def split_typed(typed: DataFrame, on_bad: str = "row") -> tuple[DataFrame, DataFrame]:
    """``(good rows, rejects)`` of ``typed_lines``."""
    bad = typed.filter(F.col("reason").isNotNull()).select("file_name", "reason", "raw")
    good = typed.filter(F.col("reason").isNull())
    if on_bad == "file":
        good = good.join(bad.select("file_name").distinct(), "file_name", "left_anti")
    good = good.select(*[f.name for f in TRANSACTIONS.fields], "file_name")
    return good, bad


def repeated_ids(batch: DataFrame) -> DataFrame:
    """``transaction_id`` of the ids that a batch has more than once."""
    return batch.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1) \
                .select("transaction_id")


def _split_repeated(batch: DataFrame, repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the ids that occur once, and of those in ``repeated`` (also the null id)."""
    ids = repeated.select(F.col("transaction_id").alias("_repeated"))
    same = F.col("transaction_id").eqNullSafe(F.col("_repeated"))
    return batch.join(ids, same, "left_anti"), batch.join(ids, same, "left_semi")


def new_transactions(batch: DataFrame, existing: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """Rows of a batch to append: one per id (the smallest row), none already
    in the fact. ``repeated`` (``repeated_ids`` of the batch, already computed):
    only their rows are grouped, which sorts them."""
    once, many = (None, batch) if repeated is None else _split_repeated(batch, repeated)
    cols = [c for c in batch.columns if c != "transaction_id"]
    first = many.groupBy("transaction_id").agg(F.min(F.struct(*cols)).alias("r"))
    rows = first.select("transaction_id", *[F.col(f"r.{c}").alias(c) for c in cols]).select(*batch.columns)
    if once is not None:
        rows = once.unionByName(rows)
    return rows.join(existing.select("transaction_id"), "transaction_id", "left_anti")


REPEATED = "transaction_id repeated in the batch"
STORED = "transaction_id stored with other values"


def duplicate_transactions(batch: DataFrame, existing: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """Reject rows ``(file_name, reason, raw)`` for ids that are not unique.

    An id that the fact holds with other values is refused; a row that equals
    the stored one is a replay and no reject. Of an id's rows in the batch
    the smallest is the one that counts, the others are refused (one reject
    per distinct line and file). ``repeated`` (``repeated_ids`` of the batch,
    already computed): other ids are only compared with the stored ones.
    """
    names = [f.name for f in TRANSACTIONS.fields]
    if "file_name" not in batch.columns:
        batch = batch.withColumn("file_name", F.lit(None).cast("string"))
    row = F.struct(*[n for n in names if n != "transaction_id"])
    once, many = (None, batch) if repeated is None else _split_repeated(batch, repeated)
    lines = many.select("transaction_id", row.alias("row"), "file_name") \
                .groupBy("transaction_id", "row", "file_name").agg(F.count(F.lit(1)).alias("n"))
    first = lines.groupBy("transaction_id").agg(
        F.min(F.struct("row", "file_name")).alias("first"))
    stored = existing.select("transaction_id", row.alias("was"))
    x = lines.join(first, "transaction_id").join(stored, "transaction_id", "left")
    is_first = F.struct("row", "file_name").eqNullSafe(F.col("first"))
    reason = (F.when(~is_first | (F.col("n") > 1), REPEATED)     # the same in a rerun, when the first is stored
               .when(F.col("was").isNotNull() & ~F.col("row").eqNullSafe(F.col("was")), STORED))
    x = x.select("transaction_id", "row", "file_name", reason.alias("reason")).filter("reason is not null")
    if once is not None:
        other = once.select("transaction_id", row.alias("row"), "file_name").join(stored, "transaction_id") \
                    .filter(~F.col("row").eqNullSafe(F.col("was")))
        x = x.unionByName(other.select("transaction_id", "row", "file_name", F.lit(STORED).alias("reason")))
    text = F.concat_ws(";", "transaction_id", F.date_format("row.transaction_date", "yyyy-MM-dd HH:mm:ss"),
                       F.regexp_replace(F.col("row.amount").cast("string"), r"\.", ","),
                       *[F.col(f"row.{n}") for n in names[3:]])
    return x.select("file_name", "reason", text.alias("raw"))
