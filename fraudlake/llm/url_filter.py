"""URL filters: rules, and a path-template tree for what no rule covers.

Paths are parsed segment by segment below their host. Digits within a
segment are generalised first (``39547.html`` -> ``#.html``). At each node of a
host's tree a segment value stays a branch of its own only if it is frequent
(``min_support`` urls, on a host of any size) and its labelled bad
rate differs significantly from the node's (a two-sided test at ``z``); the
other, variable or statistically similar, branches are merged into a
wildcard. A url's template is its way through the tree. A template is
rejected if its bad rate, smoothed towards its host's and that towards the
overall rate by ``weight`` pseudo-labels each, reaches ``max_bad``.

Urls are reduced to counts per (host, generalised path) before the tree is
built; the tree's levels are joins and groupings of those counts.

Defined cases: a null url or one without ``://`` has an empty host and path
and is judged as such; a page without label counts towards supports only;
several labels of one page are bad if any is; null labels are ignored;
without labels everything is allowed; segments beyond ``max_depth`` are one
segment; repeated rows and null or repeated ids are judged each; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import store

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Tree:
    """Parameters of the template tree."""

    max_depth: int = 6
    min_support: int = 10
    z: float = 1.96
    weight: float = 20.0
    max_bad: float = 0.25


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    empty = F.lit("")
    return F.coalesce(F.translate(host, UPPER, LOWER), empty), F.coalesce(path, empty)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule ``(host/path, verdict)`` that fits and its verdict
    (null without one); a rule fits its host, all subdomains, and paths that
    start with its own. Equal lengths: the first in the list."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):     # the longest is asked first
        h, slash, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def templates(urls: DataFrame, tree: Tree) -> DataFrame:
    """``(host, masked, template, lab, bad, verdict)`` per host and masked path
    of ``urls`` (``host, masked, bad``: 1, 0 or null)."""
    leaf = store(urls.groupBy("host", "masked").agg(
        F.count("*").alias("n"), F.count("bad").alias("lab"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
        .withColumn("segs", F.split(F.regexp_replace("masked", "^/", ""), "/", tree.max_depth))
        .withColumn("segs", F.when(F.col("masked") != "", F.col("segs")).otherwise(F.array().cast("array<string>")))
        .withColumn("template", F.lit("")), "urls")
    depth = leaf.agg(F.max(F.size("segs"))).first()[0] or 0
    cur = leaf
    for i in range(depth):
        here = cur.withColumn("seg", F.get("segs", F.lit(i)))
        sums = lambda *k: [F.sum(c).alias(f"{k[0]}_{c}") for c in ("n", "lab", "bad")]
        child = here.filter(F.col("seg").isNotNull()).groupBy("host", "template", "seg").agg(*sums("c"))
        node = child.groupBy("host", "template").agg(*[F.sum(f"c_{c}").alias(f"n_{c}") for c in ("lab", "bad")])
        rate = F.col("n_bad") / F.col("n_lab")
        differs = (F.pow(F.col("c_bad") / F.col("c_lab") - rate, F.lit(2.0)) * F.col("c_lab")
                   > F.lit(tree.z * tree.z) * rate * (1 - rate))
        own = child.join(node, ["host", "template"]).filter(
            (F.col("c_n") >= tree.min_support) & (F.col("c_lab") > 0)).filter(differs).select("host", "template", "seg", F.lit(True).alias("own"))
        step = F.when(F.col("seg").isNull(), "").otherwise(
            F.concat(F.lit("/"), F.when(F.col("own"), F.col("seg")).otherwise("*")))
        cur = store(here.join(own, ["host", "template", "seg"], "left")
                    .withColumn("template", F.concat("template", step)).select(*leaf.columns), "urls")
    t = cur.groupBy("host", "template").agg(F.sum("lab").alias("t_lab"), F.sum("bad").alias("t_bad"))
    h = t.groupBy("host").agg(F.sum("t_lab").alias("h_lab"), F.sum("t_bad").alias("h_bad"))
    all_lab, all_bad = h.agg(F.sum("h_lab"), F.sum("h_bad")).first()
    overall = (all_bad or 0) / (all_lab or 1)
    prior = (F.col("h_bad") + F.lit(tree.weight * overall)) / (F.col("h_lab") + tree.weight)
    rate = (F.col("t_bad") + F.lit(tree.weight) * prior) / (F.col("t_lab") + tree.weight)
    judged = t.join(h, "host").select("host", "template", rate.alias("bad_rate"))
    return cur.select("host", "masked", "template").join(judged, ["host", "template"]) \
              .withColumn("verdict", F.when(F.col("bad_rate") >= tree.max_bad, "block").otherwise("allow"))


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]], tree: Tree = Tree()) -> DataFrame:
    """``(page_id, host, path, rule, verdict, template, bad_rate)`` per page;
    ``labels``: ``(page_id, bad)``."""
    host, path = host_and_path(F.col("url"))
    x = pages.select("page_id", host.alias("host"), path.alias("path"))
    x = x.withColumn("masked", F.regexp_replace("path", "[0-9]+", "#"))
    bad = labels.filter("page_id is not null and bad is not null").groupBy("page_id") \
                .agg(F.max(F.col("bad").cast("int")).alias("bad"))
    t = templates(x.join(bad, "page_id", "left"), tree)
    rule, said = rule_for(F.col("host"), F.col("path"), rules)
    return x.join(t.withColumnRenamed("verdict", "own"), ["host", "masked"]).select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(said, F.col("own")).alias("verdict"),
        "template", "bad_rate")


def judge_sql(rules: list[tuple[str, str]], tree: Tree = Tree()) -> str:
    """The same as DuckDB SQL over ``pages`` and ``labels`` (quality 0 = bad)."""
    case = {"rule": "", "verdict": ""}
    for text, says in sorted(rules, key=lambda r: -len(r[0])):
        h, slash, p = text.partition("/")
        fits = f"WHEN (m.host = '{h}' OR suffix(m.host, '.{h}')) AND starts_with(path, '{slash}{p}') THEN "
        case["rule"] += f"{fits}'{text}' "
        case["verdict"] += f"{fits}'{says}' "
    levels, last = "", "l0"
    for i in range(1, tree.max_depth + 1):
        levels += f"""
c{i} AS (SELECT host, template, segs[{i}] AS seg, sum(n) AS n, sum(lab) AS lab, sum(bad) AS bad
  FROM {last} WHERE len(segs) >= {i} GROUP BY ALL),
n{i} AS (SELECT host, template, sum(lab) AS nlab, sum(bad) AS nbad FROM c{i} GROUP BY ALL),
o{i} AS (SELECT host, template, seg FROM c{i} JOIN n{i} USING (host, template)
  WHERE n >= {tree.min_support} AND lab > 0
    AND power(bad / lab - nbad / nlab, 2) * lab > {tree.z * tree.z!r}::DOUBLE * (nbad / nlab) * (1 - nbad / nlab)),
l{i} AS (SELECT l.host, l.masked, l.n, l.lab, l.bad, l.segs, l.template ||
    CASE WHEN len(l.segs) < {i} THEN '' WHEN o.seg IS NOT NULL THEN '/' || o.seg ELSE '/*' END AS template
  FROM {last} l LEFT JOIN o{i} o ON o.host = l.host AND o.template = l.template AND o.seg = l.segs[{i}]),"""
        last = f"l{i}"
    d = tree.max_depth
    return rf"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS host FROM u),
x AS (SELECT page_id, translate(host, '{UPPER}', '{LOWER}') AS host,
    regexp_extract(substr(rest, length(host) + 1), '^[^?#]*') AS path FROM h),
m AS (SELECT *, regexp_replace(path, '[0-9]+', '#', 'g') AS masked FROM x),
b AS (SELECT doc_id AS page_id, max(CASE WHEN quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels
  WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id),
f AS (SELECT host, masked, count(*) AS n, count(bad) AS lab, coalesce(sum(bad), 0) AS bad
  FROM m LEFT JOIN b USING (page_id) GROUP BY ALL),
s AS (SELECT *, CASE WHEN masked = '' THEN [] ELSE string_split(regexp_replace(masked, '^/', ''), '/') END AS s FROM f),
l0 AS (SELECT host, masked, n, lab, bad, CASE WHEN len(s) > {d}
    THEN list_append(s[1:{d - 1}], array_to_string(s[{d}:], '/')) ELSE s END AS segs, '' AS template FROM s),{levels}
t AS (SELECT host, template, sum(lab) AS tl, sum(bad) AS tb FROM {last} GROUP BY ALL),
hh AS (SELECT host, sum(tl) AS hl, sum(tb) AS hb FROM t GROUP BY host),
a AS (SELECT coalesce(sum(hb), 0) / greatest(coalesce(sum(hl), 0), 1) AS r FROM hh),
j AS (SELECT t.host, t.template, (tb + {tree.weight!r}::DOUBLE * ((hb + {tree.weight!r}::DOUBLE * r) / (hl + {tree.weight!r}::DOUBLE)))
    / (tl + {tree.weight!r}::DOUBLE) AS bad_rate FROM t JOIN hh USING (host), a)
SELECT page_id, m.host, path, CASE {case['rule']} END AS rule,
  coalesce(CASE {case['verdict']} END, CASE WHEN bad_rate >= {tree.max_bad} THEN 'block' ELSE 'allow' END) AS verdict,
  {last}.template
FROM m JOIN {last} ON m.host = {last}.host AND m.masked = {last}.masked
JOIN j ON j.host = {last}.host AND j.template = {last}.template
"""
