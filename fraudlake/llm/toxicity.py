"""Toxicity by cumulative-link ordinal regression over sparse word features.

Severity grades run from 0 (clean) to 3. The model is
``P(grade <= k) = sigmoid(theta_k - w.x)`` with one weight vector ``w``
shared by all ordered thresholds ``theta``; ``x`` holds log(1 + count) of the
document's words and of the beginnings of words (``PREFIXES`` letters), since
in inflected languages one stem has many forms, each of them rare. Weights are
never negative and a text is as toxic as its worst ``WINDOW`` words (windows overlap by
half): text appended to a toxic passage cannot hide it, as no word speaks for a text, nor does a
long clean text become toxic by its length. An L1 penalty
keeps them few, so scoring needs one small dictionary. Output: the probability of any toxicity, the expected
severity (sum over k of P(grade >= k)) and whether the document is rejected.

Labels are binary, so a toxic row's training grade is drawn from how often it
uses words that are tied to the toxic label: 1 for at most one use, 2 for
two or three, 3 for more.

The fit reads at most ``sample`` labelled rows, the smallest by a hash of
their id, and of those, in that order, as many as have ``sample_bytes`` of text in
all (one of over a sixteenth of that is passed over); scoring reads every whole text.

Defined cases: a text without features (null and empty ones too) gets the base
rate, the shares of the grades in the sample, and no text gets less;
several labels of one document count as toxic if any is; of several texts of one id the
fit takes the least; null labels and labels without a document are ignored; without
labels of both kinds every severity is 0; repeated rows are scored alike; texts of any
length are scored whole; other columns pass through, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.llm.common import fresh

WORD = re.compile(r"[^\W\d_]+")
GRADES = 3
PREFIXES = (3, 4, 5, 6)
WINDOW = 200


def features(words: Counter) -> Counter:
    """Counts of words and of the beginnings (``^abc``) of longer words."""
    out = Counter(words)
    for w, n in words.items():
        for k in PREFIXES:
            if len(w) > k:
                out["^" + w[:k]] += n
    return out


@dataclass
class OrdinalModel:
    weights: dict[str, float] = field(default_factory=dict)
    thetas: tuple[float, ...] = ()
    base: tuple[float, ...] = ()      # share of rows of grade k and more

    def _sum(self, words: list[str]) -> float | None:
        """Weighted features of a window; None without any."""
        w = self.weights
        hits: Counter = Counter()
        for word, n in Counter(words).items():
            if word in w:
                hits[word] += n
            for k in PREFIXES:
                if len(word) > k and (start := "^" + word[:k]) in w:
                    hits[start] += n
        return sum(w[k] * np.log1p(n) for k, n in hits.items()) if hits else None

    def score(self, text: str | None) -> tuple[float, float]:
        """``(p_toxic, severity)`` of one whole text."""
        if not self.thetas:
            return 0.0, 0.0
        words = WORD.findall(text.lower()) if text else []
        z = max((z for lo in range(0, max(1, len(words) - WINDOW // 2), WINDOW // 2)
                 if (z := self._sum(words[lo:lo + WINDOW])) is not None), default=None)
        p = self.base or (0.0,) * len(self.thetas)
        if z is not None:
            p = [max(b, 1.0 / (1.0 + np.exp(min(50.0, t - z)))) for b, t in zip(p, self.thetas)]
        return float(p[0]), float(sum(p))


def grades(words: list[Counter], tied: set[str], toxic: np.ndarray) -> np.ndarray:
    """Training grades of the sample's rows: how often a toxic row uses words of
    which the word or a beginning is in ``tied``."""
    uses = np.array([sum(n for w, n in c.items() if w in tied or any("^" + w[:k] in tied for k in PREFIXES if len(w) > k))
                     for c in words])
    return np.where(~toxic, 0, np.where(uses <= 1, 1, np.where(uses <= 3, 2, 3)))


def fit(words: list[Counter], toxic: np.ndarray, l1: float = 2e-4, steps: int = 400,
        min_docs: int = 5) -> OrdinalModel:
    """Accelerated proximal gradient, restarted where it overshoots, on the
    cumulative-link likelihood.

    Features in fewer than ``min_docs`` rows do not take part, nor do those not twice as
    likely in a toxic row as in another, or whose gradient without weights is below
    ``2 * l1``; frequent ones do if they tell.
    """
    n = len(words)
    if n == 0 or toxic.all() or not toxic.any():
        return OrdinalModel()
    # Only numbers are kept per row; its features' names stand once in ``at``.
    at: dict[str, int] = {}
    cols, vals = [], []
    for c in words:
        f = features(c)
        cols.append(np.array([at.setdefault(w, len(at)) for w in f], np.int32))
        vals.append(np.log1p(np.array(list(f.values()), float)))
    rows = np.repeat(np.arange(n, dtype=np.int32), [len(x) for x in cols])
    cols, vals = np.concatenate(cols), np.concatenate(vals)
    df, in1 = np.bincount(cols, minlength=len(at)), np.bincount(cols[toxic[rows]], minlength=len(at))
    n1 = int(toxic.sum())
    odds = np.log(((in1 + 1) / (n1 + 2)) / ((df - in1 + 1) / (n - n1 + 2)))
    names = list(at)
    y = grades(words, {names[i] for i in np.flatnonzero((in1 >= 5) & (odds >= 2.0))}, toxic)
    stay = (df >= min_docs) & (odds >= np.log(2))
    vocab = [names[i] for i in np.flatnonzero(stay)]
    some, new = stay[cols], np.cumsum(stay) - 1
    rows, cols, vals = rows[some], new[cols[some]].astype(np.int32), vals[some]
    del at, names, some
    dot = lambda w: np.bincount(rows, vals * w[cols], n)
    back = lambda r: np.bincount(cols, vals * r[rows], len(vocab))
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -50, 50)))

    def loss(w, th):
        """Mean of -log P(grade) and its gradients, from
        ``sig(b) - sig(a) = sig(b) sig(-a) (1 - exp(a - b))``, which neither
        cancels nor underflows; infinite where a grade that has rows gets none."""
        z = dot(w)
        cut = np.concatenate([[-np.inf], th, [np.inf]])
        a, b = cut[y] - z, cut[y + 1] - z
        gap = cut[y + 1] - cut[y]
        if gap.min() <= 0:
            return np.inf, None, None
        value = np.logaddexp(0, -b) + np.logaddexp(0, a) - np.log(-np.expm1(-gap))
        both = 1 / np.expm1(np.minimum(gap, 500.0))
        up, down = sig(-b) + both, sig(a) + both         # d log p / db, - d log p / da
        gt = np.array([down[y == k + 1].sum() - up[y == k].sum() for k in range(GRADES)]) / n
        return value.mean(), back((up - down) / n), gt

    # Start from the shares of the grades, without weights.
    share = np.clip([(y <= k).mean() for k in range(GRADES)], 1e-3, 1 - 1e-3)
    th = np.maximum.accumulate(np.log(share / (1 - share)) + 1e-3 * np.arange(GRADES))
    pull = -loss(np.zeros(len(vocab)), th)[1]
    stay = pull >= 2 * l1
    new = np.cumsum(stay) - 1
    some = stay[cols]
    rows, cols, vals = rows[some], new[cols[some]].astype(np.int32), vals[some]
    vocab = [v for v, k in zip(vocab, stay) if k]
    w = np.zeros(len(vocab))
    best = loss(w, th)[0]
    vw, vt, t, step = w, th, 1.0, 1.0
    for _ in range(steps):
        f, gw, gt = loss(vw, vt)
        if not np.isfinite(f):                            # overshot: go on from the last point
            vw, vt, t = w, th, 1.0
            f, gw, gt = loss(vw, vt)
        while True:
            nw = vw - step * gw
            nw = np.maximum(nw - step * l1, 0)
            nt = np.maximum.accumulate(vt - step * gt)
            dw, dt = nw - vw, nt - vt
            now = loss(nw, nt)[0]
            if now <= f + gw @ dw + gt @ dt + (dw @ dw + dt @ dt) / (2 * step) + 1e-12:
                break
            if step < 1e-12:                              # no descent left
                nw, nt, now = w, th, best - l1 * w.sum()
                break
            step /= 2
        now += l1 * nw.sum()
        if now > best:                                    # accelerated past the valley: restart there
            if t == 1.0:
                break
            vw, vt, t = w, th, 1.0
            continue
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vt = nw + (t - 1) / t2 * (nw - w), nt + (t - 1) / t2 * (nt - th)
        w, th, t, best, step = nw, nt, t2, now, step * 1.1
    return OrdinalModel({v: float(x) for v, x in zip(vocab, w) if x > 1e-3}, tuple(map(float, th)),
                        tuple(float((y > k).mean()) for k in range(GRADES)))


def train(docs: DataFrame, labels: DataFrame, sample: int = 4000,
          sample_bytes: int = 32 << 20) -> OrdinalModel:
    """Fit on at most ``sample`` labelled rows of ``docs`` and ``sample_bytes`` of text."""
    one = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    few = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")   # at most ``sample`` ids
    rows = rows.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")) \
               .filter(F.col("size") <= sample_bytes // 16)
    sizes = rows.groupBy("doc_id").agg(F.min(F.struct("text", "size")).getField("size").alias("size"))
    upto = F.sum("size").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))        # at most ``sample`` rows
    taken = sizes.withColumn("upto", upto).filter(F.col("upto") <= sample_bytes).select("doc_id")
    rows = rows.join(F.broadcast(taken), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.max("toxic").alias("toxic"))

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            c = [Counter(WORD.findall(t.lower())) if t else Counter() for t in f["text"]]
            yield pd.DataFrame({"doc_id": f["doc_id"], "toxic": f["toxic"] > 0,
                                "words": [" ".join(x) for x in c],
                                "counts": [list(x.values()) for x in c]})

    got = sorted(rows.mapInPandas(counted, "doc_id long, toxic boolean, words string, counts array<int>").collect(),
                 key=lambda r: r["doc_id"])
    return fit([Counter(dict(zip(r["words"].split(), r["counts"]))) for r in got],
               np.array([r["toxic"] for r in got], bool))


def score(docs: DataFrame, model: OrdinalModel, reject: float = 0.5, into: str = "toxicity") -> DataFrame:
    """``docs`` with a struct ``into`` (``p_toxic``, ``severity``,
    ``rejected``: p_toxic >= reject)."""

    @F.pandas_udf("p_toxic double, severity double")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.score(t) for t in texts], columns=["p_toxic", "severity"])

    name, = fresh(docs, "said")
    x, said = docs.select("*", run(F.col("text")).alias(name)), F.col(name)
    return x.select(*[F.col(f"`{c}`") for c in docs.columns], F.struct(
        said["p_toxic"].alias("p_toxic"), said["severity"].alias("severity"),
        (said["p_toxic"] >= reject).alias("rejected")).alias(into))
