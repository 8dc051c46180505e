"""Line deduplication by a log-template tree, in DataFrame functions only.

Fixed-depth parsing: a line's leaf is its token count and its first
``depth`` tokens after masking (a token that holds a digit is variable).
Inside a leaf, a token that stands at its position in fewer than
``min_contexts`` lines is generalised to a wildcard as well; what is left
is the line's template. A template is boilerplate, and its lines are
dropped, if it

- stands in at least ``min_contexts`` different contexts, a context being
  the leaves of the line before and the line after it. Copies of one document
  repeat a line in the same context and so count once: whole copied
  documents are left to near-duplicate removal, not emptied here;
- keeps at least ``min_constant`` of its tokens constant.

Defined cases: a null text stays null; an empty or blank line is never
dropped; a text whose lines are all dropped becomes empty; repeated rows are
counted as they are (same context) and all cleaned alike; a text may have any
number of lines; other columns pass through, whatever their names.

``drop_boilerplate`` is the same with contexts that neither the lines around
a line nor copies decide: see ``witnesses``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.llm.common import fresh, store

WILD = "<*>"


def _masked(line: Column) -> Column:
    """A line with runs of blanks as one and variable tokens masked. Most lines
    need neither, which plain searches for a tab, two blanks or a digit tell."""
    odd = line.contains("\t") | line.contains("  ")
    one = F.when(odd, F.regexp_replace(line, r"[ \t]+", " ")).otherwise(line)
    return F.trim(F.when(line.rlike("[0-9]"), F.regexp_replace(one, r"[^ ]*[0-9][^ ]*", WILD)).otherwise(one))


def _leaf(masked: Column, depth: int) -> Column:
    """Hash of token count and leading tokens; null for a blank line."""
    blanks = F.octet_length(masked) - F.octet_length(F.replace(masked, F.lit(" "), F.lit("")))
    return F.when(masked != "", F.xxhash64(blanks, F.substring_index(masked, " ", depth)))


def _words(masked: Column) -> Column:
    return F.octet_length(masked) - F.octet_length(F.replace(masked, F.lit(" "), F.lit(""))) + 1


def _text_key(text: str) -> tuple[Column, Column]:
    """Two hashes and the length of a text (96 bits and more): equal texts,
    equal key; null for a null text."""
    return (F.xxhash64(text).alias("k1"),
            F.when(F.col(text).isNotNull(), F.concat_ws("-", F.crc32(text), F.octet_length(text))).alias("k2"))


def _lines(rows: DataFrame, depth: int) -> DataFrame:
    """One row per line: its leaf, the hash of its masked form, its context."""
    x = rows.select("k1", "k2", F.transform(F.split("text", "\n"), _masked).alias("m"))
    x = x.select("k1", "k2", "m", F.transform("m", lambda t: _leaf(t, depth)).alias("lf"))
    at = lambda i: F.coalesce(F.get("lf", F.col("pos") + i), F.lit(0))
    return (x.select("k1", "k2", "lf", F.posexplode("m").alias("pos", "masked"))
             .select("k1", "k2", "pos", F.get("lf", F.col("pos")).alias("leaf"),
                     F.xxhash64("masked").alias("mh"),
                     F.xxhash64(at(-1), at(1)).alias("ctx"), "masked")
             .filter(F.col("leaf").isNotNull()))


def witnesses(lines: DataFrame, min_own: float, depth: int = 3) -> DataFrame:
    """``lines``, once per text, with the context that the rest of the text gives.

    To a line whose leaf stands in d texts, the lines of leaves in at most d / 2
    texts are its text's own. They must hold ``min_own`` of the text's words, or
    the context is null: copies and near copies share most of their lines, so none
    of them bears witness against a line of theirs. The context is one own leaf,
    the least of a hash weighted by words over texts: other documents give another,
    copies of one document the same. Blank lines, the place of the line and a
    recurring block around it do not matter.
    """
    lead = F.concat("words", F.lit(":"), F.substring_index("masked", " ", depth))
    number = F.conv(F.substring(F.md5(lead), 1, 10), 16, 10).cast("long")
    x = lines.select("k1", "k2", "pos", "leaf", "mh", "words", number.alias("number")).distinct()
    texts = x.select("leaf", "k1", "k2").distinct().groupBy("leaf").agg(F.count("*").alias("d"))
    x = x.join(texts, "leaf")
    u = (F.col("number") + 1) / F.lit(float((1 << 40) + 1))
    x = x.withColumn("lot", F.struct((-F.log(u) * F.col("d") / F.col("words")).alias("at"), "leaf"))
    whole = Window.partitionBy("k1", "k2")
    own = whole.orderBy("level").rangeBetween(Window.unboundedPreceding, -64)
    return (x.withColumn("level", F.floor(F.log2(F.col("d").cast("double")) * 64 + 1e-6))
            .select("k1", "k2", "pos", "leaf", "mh", "words",
                    F.when(F.sum("words").over(own) >= min_own * F.sum("words").over(whole),
                           F.min("lot").over(own)["leaf"]).alias("ctx")))


def _needed(words: Column, min_contexts: int, long: int | None) -> Column:
    """Contexts that make a template of so many constant words boilerplate:
    ``min_contexts`` up to a fifth of ``long`` words, then fewer, 2 from ``long`` on."""
    if long is None:
        return F.lit(min_contexts)
    short = long // 5
    less = F.ceil(min_contexts - (min_contexts - 2) * (words - short) / (long - short))
    return F.greatest(F.lit(2), F.least(F.lit(min_contexts), less)).cast("int")


def template_lines(docs: DataFrame, text: str = "text", depth: int = 3, min_contexts: int = 8,
                   min_constant: float = 0.6,
                   min_own: float | None = None, long: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(lines, templates)``.

    ``templates``: per boilerplate masked line ``leaf, mh, template, contexts,
    texts``. ``lines``: where lines of recurring leaves stand (``k1, k2`` are
    hashes of the whole text, so equal texts share their rows). With ``min_own``,
    contexts are those of ``witnesses``; with ``long`` as well, long templates need
    fewer of them (``_needed``).
    """
    rows = docs.select(F.col(text).alias("text")).select(*_text_key("text"), "text") \
               .filter(F.col("text").isNotNull())
    every = store(_lines(rows, depth), "lines")
    lines = every.drop("masked")
    if min_own is not None:
        lines = store(witnesses(every.select("*", _words(F.col("masked")).alias("words")), min_own, depth), "lines")
    size = F.lit(0) if min_own is None else F.max("words")   # all lines of a leaf have as many
    leaves = (lines.filter(F.col("ctx").isNotNull()).groupBy("leaf", "ctx").agg(size.alias("words"))
              .groupBy("leaf").agg(F.count("*").alias("n"), F.max("words").alias("words"))
              .select("leaf", "n", _needed(F.col("words"), min_contexts, long).alias("need"))
              .filter(F.col("n") >= F.col("need")).select("leaf", "need"))
    lines = store(lines.join(leaves.select("leaf"), "leaf"), "lines")
    weight = (lines.groupBy("leaf", "mh", "ctx").count().groupBy("leaf", "mh")
              .agg(F.count("ctx").alias("w")))

    # The texts of the distinct masked lines of those leaves, by token position.
    words = (every.select("leaf", "mh", "masked").join(leaves, "leaf")
             .groupBy("leaf", "mh").agg(F.first("masked").alias("masked"), F.first("need").alias("need"))
             .join(weight, ["leaf", "mh"])
             .select("leaf", "mh", "need", "w", F.posexplode(F.split("masked", " ")).alias("at", "token")))
    words = store(words, "words")
    steady = (words.groupBy("leaf", "at", "token").agg(F.sum("w").alias("s"), F.first("need").alias("need"))
              .filter((F.col("s") >= F.col("need")) & (F.col("token") != WILD))
              .select("leaf", "at", "token", F.lit(True).alias("steady")))
    shown = F.when(F.col("steady"), F.col("token")).otherwise(WILD)
    parsed = (words.join(steady, ["leaf", "at", "token"], "left")
              .groupBy("leaf", "mh")
              .agg(F.array_sort(F.collect_list(F.struct("at", shown.alias("t")))).alias("ts"),
                   F.avg(F.when(F.col("steady"), 1.0).otherwise(0.0)).alias("constant"),
                   F.count("steady").alias("words"))
              .filter(F.col("constant") >= min_constant)
              .select("leaf", "mh", F.concat_ws(" ", F.col("ts.t")).alias("template"), "words"))
    parsed = store(parsed, "parsed")
    seen = lines.drop("words").join(parsed.select("leaf", "mh", F.xxhash64("template").alias("th"), "words"),
                                    ["leaf", "mh"])
    support = (seen.groupBy("leaf", "th")
               .agg(F.count_distinct("ctx").alias("contexts"), F.count_distinct("k1", "k2").alias("texts"),
                    F.first("words").alias("words"))
               .filter(F.col("contexts") >= _needed(F.col("words"), min_contexts, long)))
    templates = parsed.drop("words").withColumn("th", F.xxhash64("template")) \
                      .join(support.drop("words"), ["leaf", "th"]).drop("th")
    return lines, templates


def drop_templates(docs: DataFrame, text: str = "text", depth: int = 3, min_contexts: int = 8,
                   min_constant: float = 0.6, dropped: str | None = None) -> DataFrame:
    """``docs`` without its boilerplate lines; other columns unchanged.

    ``dropped``: name of a column to add with the number of lines removed.
    """
    return _without(docs, text, dropped, *template_lines(docs, text, depth, min_contexts, min_constant))


def drop_boilerplate(docs: DataFrame, text: str = "text", depth: int = 3, min_contexts: int = 8,
                     min_constant: float = 0.6, min_own: float = 0.5, long: int = 50,
                     dropped: str | None = None) -> DataFrame:
    """``drop_templates`` with the contexts of ``witnesses``, which copies do not
    multiply; so a template needs its contexts only, in however many texts it stands,
    and of ``long`` constant words on two contexts are enough."""
    return _without(docs, text, dropped,
                    *template_lines(docs, text, depth, min_contexts, min_constant, min_own, long))


def _without(docs: DataFrame, text: str, dropped: str | None, lines: DataFrame, templates: DataFrame) -> DataFrame:
    # A bit for each line that goes, 64 to a word: looked up in one step per line.
    pos = F.col("pos")
    words = (lines.join(templates.select("leaf", "mh"), ["leaf", "mh"])
             .groupBy("k1", "k2", F.shiftright(pos, 6).alias("w"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), pos.bitwiseAND(63))).alias("b")))
    a, b, bits, n = fresh(docs, "k1", "k2", "bits", "gone")
    gone = (words.groupBy("k1", "k2").agg(F.map_from_entries(F.collect_list(F.struct("w", "b"))).alias("m"),
                                          F.max("w").alias("top"), F.sum(F.bit_count("b")).alias("n"))
            .select(F.col("k1").alias(a), F.col("k2").alias(b), F.col("n").cast("long").alias(n),
                    F.transform(F.sequence(F.lit(0), "top"), lambda i: 
                        F.coalesce(F.try_element_at("m", i), F.lit(0).cast("long"))).alias(bits)))
    k1, k2 = _text_key(text)
    x = docs.select("*", k1.alias(a), k2.alias(b)).join(gone, [a, b], "left")
    stays = lambda _, i: F.coalesce(F.getbit(F.get(bits, F.shiftright(i, 6)), i.bitwiseAND(63)), F.lit(0)) == 0
    new = F.when(F.col(n).isNull(), F.col(text)).otherwise(F.concat_ws("\n", F.filter(F.split(text, "\n"), stays)))
    cols = [new.alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns]
    if dropped:
        cols.append(F.coalesce(n, F.lit(0).cast("long")).alias(dropped))
    return x.select(*cols)
