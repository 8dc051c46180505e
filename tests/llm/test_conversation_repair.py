"""Conversation repair against a search over all edit strings."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from fraudlake.llm import conversation_repair as R
from fraudlake.llm.queries import QUERIES

DONE = re.compile(r"[^\x20\x09-\x0D]")


def harmed(rows):
    """The rows of one table after damage, by conversation, in order."""
    out = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        k = zlib.crc32(name.encode()) % 20
        mine = out.setdefault(conv, [])
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        mine += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return {c: sorted(x, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, x in out.items()}


def told(rows):
    """The first fault of each row."""
    seen, out = set(), []
    for _, role, text in rows:
        m = DONE.findall(text)
        out.append("blank" if not m else "duplicate" if (role, text) in seen else "truncated" if m[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows):
    """Forward search keeping, per row and role state, the least (cost, audit) -
    compared as whole strings, no digits and no shifting."""
    fault = told(rows)
    best = {"": (0, "", ())}      # state: the last role initial

    def put(to, state, w):
        if state not in to or w[:2] < to[state][:2]:
            to[state] = w

    def follow(state):
        return "a" if state == "u" else "u"

    def inserted(states):
        out = dict(states)
        for s, (c, a, r) in states.items():
            for _ in range(2):
                s = follow(s)
                c, a, r = c + 3, a + "I", r + (("user" if s == "u" else "assistant") + ":",)
                put(out, s, (c, a, r))
        return out

    for (_, role, text), f in zip(rows, fault):
        now = {}
        for s, (c, a, r) in inserted(best).items():
            put(now, s, (c + 4, a + "D", r))
            if f in ("blank", "duplicate"):
                continue
            c += 3 * (f == "truncated")
            if role[:1] == follow(s) or (role[:1] == "s" and s == ""):
                put(now, role[:1], (c, a + "K", r + (role + ":" + text,)))
            t = follow(s)
            put(now, t, (c + 3, a + "R", r + (("user" if t == "u" else "assistant") + ":" + text,)))
        best = now
    best = inserted(best)
    return min(best[s] for s in ("", "a") if s in best)


def everything(rows):
    """Every edit string up to two inserts a gap; only for a few rows."""
    fault, best = told(rows), None
    gaps = [["", "I", "II"]] * (len(rows) + 1)
    for ins in itertools.product(*gaps):
        for ed in itertools.product("DKR", repeat=len(rows)):
            audit = "".join(i + e for i, e in zip(ins, ed)) + ins[-1]
            cost, roles, row, bad = 0, "", 0, False
            for x in audit:
                need = "a" if roles.endswith("u") else "u"
                if x == "I":
                    cost, roles = cost + 3, roles + need
                    continue
                f, first = fault[row], rows[row][1][:1]
                row += 1
                if x == "D":
                    cost += 4
                    continue
                bad |= f in ("blank", "duplicate")
                cost += 3 * (f == "truncated")
                if x == "K":
                    bad |= first not in ("s", "u", "a")
                    roles += first
                else:
                    cost, roles = cost + 3, roles + need
            if not bad and re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def expected(rows):
    out = {}
    for conv, x in harmed(rows).items():
        turns = [t for t, _, _ in x if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        f = told(x)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(x, x[1:]))
        cost, audit, kept = cheapest(x)
        out[conv] = (gaps, f.count("blank"), f.count("duplicate"), f.count("truncated"), illegal, cost, audit,
                     hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def some(rng, n, roles=("user", "assistant", "system", "tool", "", None)):
    texts = ["Yes.", "No!", "why", "", None, " \t", "A. b", "ok? \n", "so"]
    return [(rng.choice([None, 0, 1, 2, 3, 5, 9]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]


def run(spark, rows, monkeypatch=None):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "conv_id long, turn long, role string, text string, block string, uid int")
    monkeypatch and monkeypatch.setattr("fraudlake.llm.queries.read", lambda *_: df)
    got = QUERIES["op11_conversation_repair"](spark, None)
    return {r["conv_id"]: tuple(r)[1:] for r in got.collect()}


def test_search_agrees_with_all_edit_strings():
    rng = random.Random(2)
    for n in (0, 1, 2, 3, 4):
        for _ in range(60 if n < 4 else 15):
            rows = [(0, r or " ", t or " ") for _, r, t in some(rng, n)]
            assert everything(rows) == cheapest(rows)[:2]
            facts = [(r[:1] if r[:1] in "sua" else "", f in ("blank", "duplicate"), f == "truncated")
                     for (_, r, _), f in zip(rows, told(rows))]
            assert R.fill(facts, R.START, None) == cheapest(rows)[:2]


def test_damaged_table(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(c, *r) for c in [*range(150), None] for r in some(rng, rng.randrange(1, 9))]
    rows += [(500, t, r, x) for t, (_, r, x) in enumerate(some(rng, 900, ("user", "assistant", "system")))]
    rows += [(600, None, "user", "Again.")] * 70 + [(700, 1, "user", "z" * 300_000 + "."), (700, 2, "assistant", "y" * 200_000)]
    rows += [(c, 0, "system", "Hello.") for c in range(800, 840)]
    rng.shuffle(rows)
    assert run(spark, rows, monkeypatch) == expected(rows)


@pytest.mark.parametrize("block", [1, 3, 7])
def test_blocks_and_joined_blocks(block):
    """Conversations cut into blocks give the same audits."""
    rng = random.Random(block)
    rows = {c: some(rng, rng.choice([1, 5, 40, 90]), ("user", "assistant", "system", "tool")) for c in range(25)}
    for c, x in rows.items():
        x = [(0, r, t or " ") for _, r, t in x]
        facts = [(r[:1] if r[:1] in "sua" else "", f in ("blank", "duplicate"), f == "truncated") for (_, r, _), f in zip(x, told(x))]
        parts = [facts[i:i + block] for i in range(0, len(facts), block)]
        nodes = [R.joints(p) for p in parts]
        mids, node = [], nodes[0]
        for other in nodes[1:]:
            *node, mid = R.join_blocks(node, other)
            mids.append(mid)
        at = min((node[0][t] + R.END[t][1], node[1][t], t) for t in R.STATES if node[0][t] is not None)[2]
        audit = R.END[at][0]
        for p, mid in zip(reversed(parts[1:]), reversed(mids)):
            s = mid[at]
            audit = R.fill(p, s, at)[1] + audit
            at = s
        assert R.fill(parts[0], R.START, at)[1] + audit == cheapest(x)[1]


def test_empty_table_and_general_rows(spark, monkeypatch):
    assert run(spark, [], monkeypatch) == {}
    rows = spark.createDataFrame([("a", 1, "user", "Hi", 0), ("a", 2, "bot", "Yes.", 1), ("b", None, "system", "Be good.", 2)],
                                 "conv string, turn long, role string, text string, uid long")
    edits, summary = R.repair(rows)
    got = [(r["edit"], r["role"], r["text"]) for r in edits.filter("conv = 'a'").orderBy("block", "at").collect()]
    assert got == [("K", "user", "Hi"), ("R", "assistant", "Yes.")]
    assert {r["conv"]: r["cost"] for r in summary.collect()} == {"a": 6, "b": 4}
