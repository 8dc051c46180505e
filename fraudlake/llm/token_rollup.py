"""Token counts as delta-maintained rollups.

Changes come in batches: ``insert`` adds a document's count, ``delete``
takes it away, ``revise`` replaces an old count (and its keys) by a new one.
A batch is reduced to signed additive totals per (source, lang, tokenizer)
before anything is shuffled or stored, so one hot source costs one row per
task. Totals are the sums over committed batches.

The totals are maintained: a commit adds a batch's signed totals to those of the last
generation and writes them as the next one, so a read is one generation, however
many batches were committed. A generation is a row per key, not per change.

Commits are idempotent: a batch's generation counts only from its commit record
on, which names the batch, the generation and the one it adds to; a batch id that
is committed already is skipped, one that died half way left no record and is
run again. There is one committing run at a time. Ids are free text: folders are named otherwise.

Defined cases: an unknown or null operation is refused before anything is written; null source or language is a key of its own; a null or empty
text has no tokens but is a document; a null count is 0; a key whose totals
are all 0 is not reported; an empty batch commits and changes nothing;
repeated rows are counted as often as they stand.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["source", "lang", "tokenizer"]
OPERATIONS = ("insert", "delete", "revise")
TOTALS = "source string, lang string, tokenizer string, docs long, tokens long"


def signed(changes: DataFrame) -> DataFrame:
    """Signed rows of changes ``(op, source, lang, tokenizer, tokens,
    old_source, old_lang, old_tokenizer, old_tokens)``; ``old_*`` is what a
    delete or revise takes away."""
    new = F.struct("source", "lang", "tokenizer", F.lit(1).alias("sign"),
                   F.coalesce("tokens", F.lit(0)).alias("n"))
    old = F.struct(F.col("old_source").alias("source"), F.col("old_lang").alias("lang"),
                   F.col("old_tokenizer").alias("tokenizer"), F.lit(-1).alias("sign"),
                   F.coalesce("old_tokens", F.lit(0)).alias("n"))
    each = (F.when(F.col("op") == "insert", F.array(new)).when(F.col("op") == "delete", F.array(old))
            .when(F.col("op") == "revise", F.array(old, new)))
    x = changes.select(F.explode(each).alias("x")).select("x.*")
    return x.groupBy(*KEYS).agg(F.sum("sign").cast("long").alias("docs"),
                                F.sum(F.col("sign") * F.col("n")).cast("long").alias("tokens"))


class TokenRollup:
    """Rollup tables under one shared folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], schema)

    def committed(self) -> DataFrame:
        """``(batch, number, folder)``: a row per batch, in the order of ``number``."""
        return self._read("commits", "batch string, number long, folder string")

    def _last(self) -> tuple[int, str | None]:
        r = self.committed().agg(F.max(F.struct("number", "folder")).alias("m")).first()["m"]
        return (r["number"], r["folder"]) if r else (0, None)

    def _generation(self, folder: str | None) -> DataFrame:
        return self._read(f"totals/{folder}", TOTALS) if folder else self.spark.createDataFrame([], TOTALS)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch; False if it is committed already."""
        if not self.committed().filter(F.col("batch") == F.lit(batch)).isEmpty():
            return False
        odd = changes.filter(~F.coalesce(F.col("op").isin(*OPERATIONS), F.lit(False))).select("op").limit(1).collect()
        if odd:
            raise ValueError(f"unknown operation {odd[0]['op']!r}; known: {', '.join(OPERATIONS)}")
        number, was = self._last()
        folder = uuid.uuid4().hex
        now = self._generation(was).unionByName(signed(changes)).groupBy(*KEYS) \
                  .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs != 0 or tokens != 0")
        now.write.parquet(f"{self.root}/totals/{folder}")
        self.spark.createDataFrame([(batch, number + 1, folder)], "batch string, number long, folder string").coalesce(1) \
            .write.mode("append").parquet(f"{self.root}/commits")
        return True

    def totals(self) -> DataFrame:
        return self._generation(self._last()[1])


def count_tokens(docs: DataFrame, tokenizers: dict[str, str]) -> DataFrame:
    """``docs`` (with a column ``text``, which goes) with a long column of
    token counts per entry of ``tokenizers`` (vocabulary -> SQL condition on
    the row; null where the condition fails)."""

    def counter(name: str):
        @F.pandas_udf("long")
        def count(texts: pd.Series) -> pd.Series:
            from fraudlake.llm.tokens import encode
            return pd.Series([None if t is None else len(encode(t, name)) for t in texts], dtype="Int64")
        return count

    body = F.coalesce("text", F.lit(""))
    return docs.select("*", *[counter(name)(F.when(F.expr(cond), body)).alias(name)
                              for name, cond in tokenizers.items()]).drop("text")
