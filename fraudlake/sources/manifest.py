"""File manifest: which daily files exist, which to load next, which are repeats.

Names follow ``<kind>_DDMMYYYY.<ext>``. The manifest is a DataFrame of file
metadata (``binaryFile`` without the content column reads no file bodies).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.functions.expr import base_name, file_date, file_ext, file_kind
from fraudlake.sources.fixture import table

# The three feeds and their extensions.
FEEDS = (("transactions", "txt"), ("passport_blacklist", "xlsx"), ("terminals", "xlsx"))


def with_name_parts(df: DataFrame, name: str = "file_name") -> DataFrame:
    return df.select("*", file_kind(name).alias("kind"), file_date(name).alias("file_date"),
                     file_ext(name).alias("ext"))


def list_files(spark: SparkSession, folder_glob: str) -> DataFrame:
    """Files in a landing folder: name, kind, date from the name, size, mtime."""
    files = (spark.read.format("binaryFile").load(folder_glob)
             .select(base_name("path").alias("file_name"), "path", "length", "modificationTime"))
    return with_name_parts(files)


def fixture_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per feed per day that has events."""
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("d")).distinct()
    kinds = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(e).alias("e")) for k, e in FEEDS])
    names = days.select(F.inline(F.transform(kinds, lambda s: F.struct(
        F.concat(s["k"], F.lit("_"), F.date_format("d", "ddMMyyyy"), F.lit("."), s["e"])
         .alias("file_name")))))
    return with_name_parts(names)


def oldest_batch(manifest: DataFrame) -> DataFrame:
    """Per feed kind, the file with the earliest date in its name."""
    best = F.min(F.struct("file_date", "file_name")).alias("b")
    return (manifest.filter(F.col("file_date").isNotNull())
            .groupBy("kind").agg(best)
            .select("kind", F.col("b.file_date").alias("file_date"), F.col("b.file_name").alias("file_name")))


def _archived(archive: DataFrame) -> DataFrame:
    return archive.select(F.regexp_replace("file_name", r"\.backup$", "").alias("file_name"))


def unseen(manifest: DataFrame, archive: DataFrame) -> DataFrame:
    """Files to load: not yet present in the archive as ``<name>.backup``."""
    return manifest.join(_archived(archive), "file_name", "left_anti")


def already_loaded(manifest: DataFrame, archive: DataFrame) -> DataFrame:
    """Repeats of loaded files: these go to quarantine."""
    return manifest.join(_archived(archive), "file_name", "left_semi")
