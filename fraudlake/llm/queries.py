"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fraudlake.llm import conversation_repair as conversations, decontam, packing, toxicity
from fraudlake.llm.common import read, scratch_root, store
from fraudlake.llm.embed_dedup import near_vectors
from fraudlake.llm.line_templates import drop_boilerplate
from fraudlake.llm.minhash_dedup import near_documents
from fraudlake.llm.sharding import shard_documents
from fraudlake.llm.suffix_dedup import remove_repeats
from fraudlake.llm.token_alignment import align_documents
from fraudlake.llm.token_rollup import TokenRollup, count_tokens
from fraudlake.llm.url_filter import judge, judge_sql
from fraudlake.llm.vector_search import search

SHARDS = 40
RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block")]


def q_op1_suffix_repeats(spark, sf):
    """Every document without the bytes of 100-byte strings that start earlier."""
    return remove_repeats(read(spark, sf, "documents"), 100).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def q_op2_template_urls(spark, sf):
    """Every page's verdict; a page's label is that of its id (quality 0 is bad)."""
    labels = read(spark, sf, "labels").select(F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("bad"))
    return judge(read(spark, sf, "pages"), labels, RULES).drop("bad_rate")


def q_op3_ordinal_toxicity(spark, sf):
    """Every document's expected severity and whether it is rejected."""
    docs = read(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read(spark, sf, "labels"))
    return toxicity.score(docs, model).select("doc_id", "toxicity.*")


def q_op4_mixture_packing(spark, sf):
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack(read(spark, sf, "documents")).drop("tokens")


def q_op5_edit_decontamination(spark, sf):
    """Documents that hold a benchmark item, with the item's edit distance."""
    return decontam.contaminated(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


def q_op6_line_templates(spark, sf):
    """Every document with its text after boilerplate lines are dropped."""
    out = drop_boilerplate(read(spark, sf, "documents").select("doc_id", "text"), dropped="n_dropped")
    return out.select("doc_id", "n_dropped", "text")


def q_op7_balanced_shards(spark, sf):
    """Every document's shard; law ``rows``: counts at most one apart."""
    return shard_documents(read(spark, sf, "documents"), SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def q_op8_hyperplane_vectors(spark, sf):
    """Every vector's number of links and component at cosine 0.9."""
    return near_vectors(read(spark, sf, "embeddings"), 0.9)


def q_op9_hamming_minhash(spark, sf):
    """Every document's component at 3-word similarity 0.85."""
    return near_documents(read(spark, sf, "documents"), words=3, percent=85).select(
        "doc_id", "n_shingles", "component_id", "kept")


def token_changes(spark, sf):
    """Three batches of changes drawn from the documents: all are inserted with
    their counts, those not in English are revised to a vocabulary for many
    languages, and later copies of a text are deleted."""
    docs = read(spark, sf, "documents").select("doc_id", "source", "lang", "text",
                                               F.xxhash64("text").alias("key"))
    n = store(count_tokens(docs, {"byte_bpe_50k": "true", "byte_bpe_multi_50k": "lang <> 'en'"}), "counts")
    name = lambda x: F.lit(x).alias
    none = F.lit(None).cast("string")
    multi = F.col("byte_bpe_multi_50k").isNotNull()
    insert = n.select(F.lit("insert").alias("op"), "source", "lang", name("byte_bpe_50k")("tokenizer"),
                      F.col("byte_bpe_50k").alias("tokens"), none.alias("old_source"), none.alias("old_lang"),
                      none.alias("old_tokenizer"), F.lit(None).cast("long").alias("old_tokens"))
    old = [F.col("source").alias("old_source"), F.col("lang").alias("old_lang")]
    revise = n.filter(multi).select(
        F.lit("revise").alias("op"), "source", "lang", name("byte_bpe_multi_50k")("tokenizer"),
        F.col("byte_bpe_multi_50k").alias("tokens"), *old, name("byte_bpe_50k")("old_tokenizer"),
        F.col("byte_bpe_50k").alias("old_tokens"))
    first = n.filter(F.col("key").isNotNull()).groupBy("key").agg(F.min("doc_id").alias("first"))
    gone = n.join(first, "key").filter(F.col("doc_id") != F.col("first"))
    delete = gone.select(
        F.lit("delete").alias("op"), none.alias("source"), none.alias("lang"), none.alias("tokenizer"),
        F.lit(None).cast("long").alias("tokens"), *old,
        F.when(multi, "byte_bpe_multi_50k").otherwise("byte_bpe_50k").alias("old_tokenizer"),
        F.coalesce("byte_bpe_multi_50k", "byte_bpe_50k").alias("old_tokens"))
    return [("load", insert), ("retokenize", revise), ("copies", delete)]


def q_op10_token_rollup(spark, sf):
    """Totals by source, language and vocabulary after three batches, the
    first of them delivered twice."""
    rollup = TokenRollup(spark, f"{scratch_root(spark)}/rollup-{uuid.uuid4().hex}")
    batches = token_changes(spark, sf)
    for batch, changes in [*batches, batches[0]]:
        rollup.commit(batch, changes)
    return rollup.totals()


def q_op11_conversation_repair(spark, sf):
    """Every conversation's faults, cheapest repair and the repaired rows' digest."""
    given = read(spark, sf, "conversations")
    edits, summary = conversations.repair(conversations.damage(given))
    ids = given.select(conversations.conversation_key().alias("conv")).distinct()
    out = ids.join(summary, "conv", "left").join(conversations.digests(edits), "conv", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in
            ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.expr("cast(nullif(substr(conv, 2), '') as bigint)").alias("conv_id"), *zero,
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def q_op12_polytope_search(spark, sf):
    """The 20 nearest vectors of each vector whose id is divisible by 20."""
    return search(read(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def q_op13_token_alignment(spark, sf):
    """Every document's alignment of two vocabularies, measured over the corpus."""
    return align_documents(read(spark, sf, "documents"))[0]


QUERIES = {
    "op1_suffix_repeats": q_op1_suffix_repeats,
    "op2_template_urls": q_op2_template_urls,
    "op3_ordinal_toxicity": q_op3_ordinal_toxicity,
    "op4_mixture_packing": q_op4_mixture_packing,
    "op5_edit_decontamination": q_op5_edit_decontamination,
    "op6_line_templates": q_op6_line_templates,
    "op7_balanced_shards": q_op7_balanced_shards,
    "op8_hyperplane_vectors": q_op8_hyperplane_vectors,
    "op9_hamming_minhash": q_op9_hamming_minhash,
    "op10_token_rollup": q_op10_token_rollup,
    "op11_conversation_repair": q_op11_conversation_repair,
    "op12_polytope_search": q_op12_polytope_search,
    "op13_token_alignment": q_op13_token_alignment,
}

_OP6 = r"""
WITH rows_ AS (
  SELECT DISTINCT text FROM documents WHERE text IS NOT NULL),
arr AS (
  SELECT text, list_transform(string_split(text, chr(10)), lambda s:
    regexp_replace(trim(regexp_replace(s, '[ \t]+', ' ', 'g'), ' '), '[^ ]*[0-9][^ ]*', '<*>', 'g')) AS m
  FROM rows_),
pos AS (SELECT text, m, unnest(range(1, len(m) + 1)) AS p FROM arr),
lines AS (
  SELECT text, p, m[p] AS masked, len(string_split(m[p], ' ')) AS words,
         len(string_split(m[p], ' ')) || ':' || array_to_string(string_split(m[p], ' ')[1:3], ' ') AS leaf
  FROM pos WHERE m[p] <> ''),
spread AS (SELECT leaf, count(DISTINCT text) AS d FROM lines GROUP BY leaf),
lots AS (
  SELECT l.*, floor(log2(d) * 64 + 1e-6) AS level,
         -ln((('0x' || substr(md5(leaf), 1, 10))::BIGINT + 1)::DOUBLE / 1099511627777::DOUBLE) * d / words AS lot
  FROM lines l JOIN spread USING (leaf)),
seen AS MATERIALIZED (
  SELECT text, p, masked, leaf, words,
         CASE WHEN sum(words) OVER own >= 0.5 * sum(words) OVER (PARTITION BY text)
              THEN arg_min(leaf, lot) OVER own END AS ctx
  FROM lots WINDOW own AS (PARTITION BY text ORDER BY level RANGE BETWEEN UNBOUNDED PRECEDING AND 64 PRECEDING)),
leaves AS (
  SELECT leaf, greatest(2, least(8, ceil(8 - 6 * (max(words) - 10) / 40.0))) AS need
  FROM seen WHERE ctx IS NOT NULL GROUP BY leaf
  HAVING count(DISTINCT ctx) >= greatest(2, least(8, ceil(8 - 6 * (max(words) - 10) / 40.0)))),
w AS (
  SELECT leaf, masked, need, count(DISTINCT ctx) AS w FROM seen JOIN leaves USING (leaf) GROUP BY ALL),
toks AS (
  SELECT leaf, masked, need, w, unnest(range(1, len(string_split(masked, ' ')) + 1)) AS a,
         unnest(string_split(masked, ' ')) AS token FROM w),
steady AS (
  SELECT leaf, a, token FROM toks WHERE token <> '<*>' GROUP BY leaf, a, token, need HAVING sum(w) >= need),
parsed AS (
  SELECT t.leaf, t.masked, count(s.token) AS constant,
         string_agg(CASE WHEN s.token IS NOT NULL THEN t.token ELSE '<*>' END, ' ' ORDER BY t.a) AS template
  FROM toks t LEFT JOIN steady s ON t.leaf = s.leaf AND t.a = s.a AND t.token = s.token
  GROUP BY t.leaf, t.masked
  HAVING avg(CASE WHEN s.token IS NOT NULL THEN 1.0 ELSE 0.0 END) >= 0.6),
good AS (
  SELECT leaf, template FROM seen JOIN parsed USING (leaf, masked) GROUP BY ALL
  HAVING count(DISTINCT ctx) >= greatest(2, least(8, ceil(8 - 6 * (max(constant) - 10) / 40.0)))),
bad AS (SELECT DISTINCT masked FROM parsed JOIN good USING (leaf, template)),
cleaned AS (
  SELECT l.text, count(b.masked) AS n,
         array_to_string(list(string_split(l.text, chr(10))[p] ORDER BY p)
                         FILTER (WHERE b.masked IS NULL), chr(10)) AS kept
  FROM (SELECT text, m[p] AS masked, p FROM pos) l LEFT JOIN bad b USING (masked)
  GROUP BY l.text)
SELECT d.doc_id, coalesce(c.n, 0) AS n_dropped,
       CASE WHEN coalesce(c.n, 0) = 0 THEN d.text ELSE coalesce(c.kept, '') END AS text
FROM documents d LEFT JOIN cleaned c ON d.text = c.text
"""

_OP8 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
link AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, c.c AS component_id, v.vec_id = c.c AS kept
FROM v JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) c ON c.a = v.vec_id
LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) n ON n.a = v.vec_id
"""

_OP9 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1),
           lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
x AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
link AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT s.doc_id, len(s.s) AS n_shingles, c.c AS component_id, s.doc_id = c.c AS kept
FROM s JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) c ON c.a = s.doc_id
"""

_OP11 = r"""
WITH RECURSIVE tab AS (
  SELECT list(list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab
  FROM (SELECT i::BIGINT AS i FROM range(256) r(i))),
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_concat([4294967295], list_transform(
           string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
           lambda x: ord(x)::BIGINT)), lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 AS k
  FROM conversations, tab),
rows_ AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM given WHERE k <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS fin FROM rows_),
x AS MATERIALIZED (
  SELECT *, CASE WHEN fin = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN fin NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         left(role, 1) || coalesce(lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i), '-') AS pair,
         count(*) OVER (PARTITION BY conv_id) = i AS final
  FROM placed),
per AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (NOT final AND pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM x GROUP BY conv_id),
state(s, follow, says) AS (VALUES ('', 'u', 'user:'), ('s', 'u', 'user:'), ('u', 'a', 'assistant:'), ('a', 'u', 'user:')),
gap AS (
  SELECT s AS s0, s, '' AS pre, 0 AS c, []::VARCHAR[] AS ins FROM state
  UNION ALL SELECT s, follow, 'I', 3, [says] FROM state),
best AS (
  SELECT conv_id, n + 1 AS i, s, {c: c::BIGINT, a: a, r: r} AS w
  FROM per, (VALUES ('', 0, '', []::VARCHAR[]), ('s', 6, 'II', ['user:', 'assistant:']),
                    ('u', 3, 'I', ['assistant:']), ('a', 0, '', []::VARCHAR[])) e(s, c, a, r)
  UNION ALL
  SELECT conv_id, i, s0, min({c: c, a: a, r: r}) FROM (
    SELECT b.conv_id, x.i, g.s0,
           g.c + b.w.c + CASE e WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
             + CASE WHEN e <> 'D' AND fault = 'truncated' THEN 3 ELSE 0 END AS c,
           g.pre || e || b.w.a AS a,
           list_concat(g.ins, CASE e WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [role || ':' || text]
                                ELSE [says || text] END, b.w.r) AS r
    FROM best b JOIN x ON x.conv_id IS NOT DISTINCT FROM b.conv_id AND x.i = b.i - 1,
         gap g JOIN state t ON t.s = g.s, (VALUES ('D'), ('K'), ('R')) l(e)
    WHERE CASE e WHEN 'D' THEN b.s = g.s
               WHEN 'R' THEN fault NOT IN ('blank', 'duplicate') AND b.s = follow
               ELSE fault NOT IN ('blank', 'duplicate') AND b.s = left(role, 1)
                    AND (b.s = follow OR b.s = 's' AND g.s = '') END)
  GROUP BY conv_id, i, s0)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.w.c, 0) AS cost,
       coalesce(b.w.a, '') AS audit, sha256(coalesce(array_to_string(b.w.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d
LEFT JOIN per p ON p.conv_id IS NOT DISTINCT FROM d.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM d.conv_id AND b.i = 1 AND b.s = ''
"""

ORACLE_SQL = {
    "op2_template_urls": judge_sql(RULES),
    "op6_line_templates": _OP6,
    "op8_hyperplane_vectors": _OP8,
    "op9_hamming_minhash": _OP9,
    "op11_conversation_repair": _OP11,
}
