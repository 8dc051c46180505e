"""Conversation structure repair: the cheapest edits that give a conversation the
role order ``(system? (user assistant)+)?``, decided by integer minima.

Edits, in the order of the rows: ``K`` keep (0), ``R`` rerole to user or
assistant (3), ``D`` delete (4, required for blank and duplicate rows), ``I``
insert an empty user or assistant row (3); a truncated row that is not deleted
adds 3. Among the cheapest, the ASCII-least string of letters (the audit) wins.

Both wishes are one number. A path's weight is a big integer whose high part
is its cost and whose low part is the audit, one fixed-width digit a letter
from the left, padded with zero digits at the end; so ``min`` of integers is
"cheapest, then least audit". The DAG has a node for each (row, state) with
state = start, system, user or assistant seen last, and is walked from the
last row to the first: an edge puts its letters before the digits found so far.

A conversation may hold any share of the rows, so the walk is split. Rows are
range-partitioned by (conversation, turn) and cut into blocks of ``BLOCK``
rows. A block gives, for each entry state and exit state, its least cost and
the place of its least audit among the exits. That is enough to join blocks: inserts
stand before a row's letter, never at a block's end, so the audits of one block
and entry are no prefixes of each other, and two of them are equal only for
the same exit. Joined blocks are rows of the same kind, joined again (512 to one)
until a conversation is one row; then the choices go back down, and each block
writes its rows' edits. No task holds more than 512 blocks of a conversation.

Two inserts in a row never pay (without both the order is still right, unless
only a system row is left, and deleting that costs less), so an edge holds one at most.

Order of rows: turn (null first), then role, the text's first 64 characters,
the text's SHA-256 (repeated rows are alike). Defined cases: null roles and
texts count as one space; a null conversation id is a conversation; an empty table gives
an empty result; text length matters nowhere but in hashing; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import partitions, store

#: ASCII order of the letters is the order of the digits; 0 pads the end.
DIGITS = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTERS = {v: k for k, v in DIGITS.items()}
BITS = 3
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: The state that a user or assistant row leads to, from each state.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: What ends a conversation in each state: letters, cost.
END = {START: ("", 0), SYSTEM: ("II", 2 * INSERT), USER: ("I", INSERT), ASSISTANT: ("", 0)}
ROLE = {USER: "user", ASSISTANT: "assistant"}
BLOCK = 256
FAN = 512
WHITE = " \t\n\x0b\x0c\r"


@lru_cache(maxsize=None)
def edges(initial: str, dead: bool, cut: bool) -> tuple[tuple[tuple[str, int, int], ...], ...]:
    """For each state the edges over a row: ``(letters, cost, state after)``."""
    out = []
    for s in STATES:
        mine = []
        for pre, at, cost in (("", s, 0), ("I", NEXT[s], INSERT)):
            mine.append((pre + "D", cost + DELETE, at))
            if dead:
                continue
            extra = cost + (TRUNCATED if cut else 0)
            if initial == "s" and at == START:
                mine.append((pre + "K", extra, SYSTEM))
            elif initial == {USER: "u", ASSISTANT: "a"}[NEXT[at]]:
                mine.append((pre + "K", extra, NEXT[at]))
            mine.append((pre + "R", extra + REROLE, NEXT[at]))
        out.append(tuple(mine))
    return tuple(out)


def weight(letters: str, cost: int, width: int) -> int:
    digits = 0
    for i, x in enumerate(letters):
        digits |= DIGITS[x] << BITS * (width - 1 - i)
    return (cost << BITS * width) + digits


def least(rows: list[tuple[str, bool, bool]], ends: dict[int, int], width: int) -> list[int | None]:
    """Least weight of the edits of ``rows`` from each entry state, where
    ``ends`` gives the weight of what follows each exit state."""
    low = (1 << BITS * width) - 1
    best = [ends.get(s) for s in STATES]
    for row in reversed(rows):
        now: list[int | None] = []
        for s in STATES:
            top = None
            for letters, cost, to in edges(*row)[s]:
                if (after := best[to]) is None:
                    continue
                digits = after & low
                w = after - digits + (digits >> BITS * len(letters)) + weight(letters, cost, width)
                if top is None or w < top:
                    top = w
            now.append(top)
        best = now
    return best


def letters_of(value: int, width: int) -> tuple[int, str]:
    digits, out = value & (1 << BITS * width) - 1, []
    for i in range(width - 1, -1, -1):
        if not (d := digits >> BITS * i & (1 << BITS) - 1):
            break
        out.append(LETTERS[d])
    return value >> BITS * width, "".join(out)


def joints(rows: list[tuple[str, bool, bool]]) -> tuple[list, list]:
    """Cost and rank of a block for ``(entry, exit)``, flat; None: no such path."""
    width = 2 * len(rows)
    by_exit = [least(rows, {t: 0}, width) for t in STATES]
    cost: list[int | None] = [None] * 16
    rank: list[int | None] = [None] * 16
    low = (1 << BITS * width) - 1
    for s in STATES:
        have = [t for t in STATES if by_exit[t][s] is not None]
        for r, t in enumerate(sorted(have, key=lambda t: by_exit[t][s] & low)):
            cost[4 * s + t], rank[4 * s + t] = by_exit[t][s] >> BITS * width, r
    return cost, rank


def join_blocks(a: tuple[list, list], b: tuple[list, list]) -> tuple[list, list, list]:
    """Cost, rank and the state between, of block ``a`` followed by ``b``."""
    cost: list[int | None] = [None] * 16
    rank: list[int | None] = [None] * 16
    mid: list[int | None] = [None] * 16
    for s in STATES:
        at = {}
        for u in STATES:
            ways = [(a[0][4 * s + t] + b[0][4 * t + u], a[1][4 * s + t], t) for t in STATES
                    if a[0][4 * s + t] is not None and b[0][4 * t + u] is not None]
            if ways:
                c, r, t = min(ways)
                cost[4 * s + u], mid[4 * s + u], at[u] = c, t, (r, b[1][4 * t + u])
        for r, u in enumerate(sorted(at, key=at.get)):
            rank[4 * s + u] = r
    return cost, rank, mid


def fill(rows: list[tuple[str, bool, bool]], entry: int, leave: int | None) -> tuple[int, str]:
    """Cost and audit of a block between two states; to the conversation's end if ``leave`` is None."""
    width = 2 * len(rows) + 2
    ends = {leave: 0} if leave is not None else {t: weight(x, c, width) for t, (x, c) in END.items()}
    return letters_of(least(rows, ends, width)[entry], width)


def replay(audit: str, initials: list[str], entry: int) -> list[tuple[str, int | None, str | None]]:
    """``(letter, row, new role)`` of an audit; the role is None where a row keeps its own or goes."""
    out, at, row = [], entry, 0
    for x in audit:
        i = None if x == "I" else row
        row += x != "I"
        if x == "D":
            out.append((x, i, None))
        elif x == "K" and initials[i] == "s":
            out.append((x, i, None))
            at = SYSTEM
        else:
            at = NEXT[at]
            out.append((x, i, None if x == "K" else ROLE[at]))
    return out


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` (conv, turn, role, text, uid) with the first fault of each as
    ``fault``, without the texts: blank, duplicate (role and text seen earlier
    in the conversation), truncated."""
    bare = F.rtrim("text", F.lit(WHITE))
    flags = rows.select(
        "conv", "turn", "role", "uid", F.left("text", F.lit(64)).alias("head"), F.sha2("text", 256).alias("digest"),
        (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    order = F.struct(F.col("turn").isNotNull().alias("k"), F.coalesce("turn", F.lit(0)).alias("turn"), "uid")
    first = flags.filter("not blank").groupBy("conv", "role", "digest").agg(F.min(order).getField("uid").alias("first"))
    x = flags.join(first, ["conv", "role", "digest"], "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("first") != F.col("uid"), "duplicate") \
             .when(F.col("cut"), "truncated")
    return x.select("conv", "turn", "role", "head", "digest", "uid", fault.alias("fault"))


NODE = "conv string, block long, first string, last string, illegal long, cost array<long>, rank array<int>"


def legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def runs(frames: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    """Runs of one conversation in a sorted partition, ``most`` rows at a time."""
    rest = None
    for f in frames:
        f = f if rest is None else pd.concat([rest, f], ignore_index=True)
        if f.empty:
            continue
        new = [*f["conv"].ne(f["conv"].shift()).to_numpy().nonzero()[0], len(f)]
        for a, b in zip(new, new[1:]):
            while b - a >= most or (a < b < len(f)):
                yield f.iloc[a:min(b, a + most)]
                a = min(b, a + most)
        rest = f.iloc[a:b]
    if rest is not None and len(rest):
        yield rest


def block_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A block a row: the facts of its rows and its joints."""
    from pyspark import TaskContext
    n = TaskContext.get().partitionId() << 40
    out = []
    for g in runs(frames, BLOCK):
        initials = [x[:1] for x in g["role"]]
        facts = [(x if x in "sua" else "", f in ("blank", "duplicate"), f == "truncated")
                 for x, f in zip(initials, g["fault"])]
        cost, rank = joints(facts)
        bad = sum(not legal(a, b) for a, b in zip(initials, initials[1:]))
        out.append((g["conv"].iloc[0], n, initials[0], initials[-1], bad, cost, rank, list(g["uid"]),
                    [x for x, _, _ in facts], [("D" if d else "T" if t else "-") for _, d, t in facts]))
        n += 1
        if len(out) == 64:
            yield frame(out)
            out = []
    if out:
        yield frame(out)


LEAF = NODE + ", uids array<long>, initials array<string>, facts array<string>"


def frame(out: list[tuple]) -> pd.DataFrame:
    names = ["conv", "block", "first", "last", "illegal", "cost", "rank", "uids", "initials", "facts"]
    return pd.DataFrame(out, columns=names)


def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of blocks joined to one row each; ``children`` = the blocks with the
    states between them, for every way through."""
    from pyspark import TaskContext
    n = TaskContext.get().partitionId() << 40
    for g in runs(frames, FAN):
        steps = []
        node = None
        bad = 0
        for f, la, il, c, r in zip(g["first"], g["last"], g["illegal"], g["cost"], g["rank"]):
            c, r = ([None if pd.isna(x) else int(x) for x in y] for y in (c, r))
            bad += int(il)
            if node is None:
                node, steps, last = (c, r), [[None] * 16], la
                continue
            bad += not legal(last, f)
            cost, rank, mid = join_blocks(node, (c, r))
            node, last = (cost, rank), la
            steps.append(mid)
        yield pd.DataFrame({"conv": g["conv"].iloc[:1].values, "block": [n], "first": [g["first"].iloc[0]],
                            "last": [last], "illegal": [bad], "cost": [node[0]], "rank": [node[1]],
                            "children": [list(map(int, g["block"]))], "steps": [steps]})
        n += 1


def descend(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The states at both ends of each child of a joined row."""
    for f in frames:
        out = []
        for s, t, children, steps in zip(f["entry"], f["leave"], f["children"], f["steps"]):
            at = int(t)
            for i in range(len(children) - 1, 0, -1):
                mid = int(steps[i][4 * int(s) + at])
                out.append((int(children[i]), mid, at))
                at = mid
            out.append((int(children[0]), int(s), at))
        yield pd.DataFrame(out, columns=["block", "entry", "leave"])


def decide(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(blocks, ends)`` of rows with ``fault``: the stored blocks with their
    ``entry`` and ``leave`` states, and per conversation its exit state, cost
    and number of adjacent rows that cannot follow each other."""
    spark = rows.sparkSession
    keys = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "head", "digest", "uid")]
    light = rows.select("conv", "turn", "role", "head", "digest", "uid", "fault")
    ranged = light.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys)
    leaves = store(ranged.select("conv", "role", "uid", "fault").mapInPandas(block_rows, LEAF), "turns")
    level, up = leaves.select(*[x.split()[0] for x in NODE.split(", ")]), []
    while True:
        size = level.groupBy("conv").agg(F.count("*").alias("n")).agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
        if (size["most"] or 1) == 1:
            break
        order = ["conv", "block"]
        parts = min(partitions(spark), -(-size["n"] // (FAN * 8)))
        up.append(store(level.repartitionByRange(max(1, parts), *order).sortWithinPartitions(*order)
                        .mapInPandas(fold, NODE + ", children array<long>, steps array<array<int>>"), "joined"))
        level = up[-1].select(*level.columns)

    exits = [F.struct((F.col("cost")[t] + END[t][1]).alias("cost"), F.col("rank")[t].alias("rank"), F.lit(t).alias("leave"))
             for t in STATES]
    whole = F.array_min(F.filter(F.array(*exits), lambda x: x["cost"].isNotNull()))
    roots = store(level.select("conv", "block", "illegal", whole.alias("x")).select(
        "conv", "block", "illegal", "x.cost", "x.leave"), "roots")
    ends = roots.select("conv", "illegal", "leave", "cost")
    states = roots.select("block", F.lit(START).alias("entry"), "leave")
    for joined in reversed(up):
        states = store(joined.select("block", "children", "steps").join(states, "block")
                       .mapInPandas(descend, "block long, entry int, leave int"), "states")
    return leaves.join(states, "block"), ends


def edit_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        out = []
        for conv, block, uids, initials, facts, s, t in zip(f["conv"], f["block"], f["uids"], f["initials"], f["facts"],
                                                            f["entry"], f["leave"]):
            initials = list(initials)
            rows = [(x, y == "D", y == "T") for x, y in zip(initials, facts)]
            _, audit = fill(rows, int(s), int(t))
            for i, (x, row, role) in enumerate(replay(audit, initials, int(s))):
                out.append((conv, block, i, x, None if row is None else int(uids[row]), role))
        g = pd.DataFrame(out, columns=["conv", "block", "at", "edit", "uid", "new_role"])
        yield g.astype({"uid": "Int64"})


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(edits, summary)`` of stored rows (conv string, turn long, role, text, uid).

    ``edits``: one row per audit letter in the order (conv, block, at) with
    ``edit``, ``role`` and ``text`` of the repaired row (null where deleted).
    ``summary``: per conversation ``gaps, blank, duplicate, truncated, illegal, cost``.
    """
    told = store(faults(rows), "faults")
    blocks, ends = decide(told)
    edits = blocks.select("conv", "block", "uids", "initials", "facts", "entry", "leave").mapInPandas(
        edit_rows, "conv string, block long, at int, edit string, uid long, new_role string")
    last = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.lit(i).alias("at"), F.lit(r).alias("new_role"))
                               for t, rs in ((SYSTEM, ["user", "assistant"]), (USER, ["assistant"]))
                               for i, r in enumerate(rs)]))
    tails = ends.withColumn("x", last).filter("x.t = leave").select(
        "conv", F.lit(2**62).alias("block"), F.col("x.at").alias("at"), F.lit("I").alias("edit"),
        F.lit(None).cast("long").alias("uid"), F.col("x.new_role").alias("new_role"))
    # Inserted rows need no text; the others are joined to theirs by row.
    own = edits.filter("uid is not null").join(rows.select("uid", "role", "text"), "uid")
    gone = F.col("edit") == "D"
    own = own.select("conv", "block", "at", "edit", F.when(~gone, F.coalesce("new_role", "role")).alias("role"),
                     F.when(~gone, F.col("text")).alias("text"))
    new = edits.filter("uid is null").unionByName(tails).select(
        "conv", "block", "at", "edit", F.col("new_role").alias("role"), F.lit("").alias("text"))
    per = told.groupBy("conv", "turn").agg(*[F.count_if(F.col("fault") == x).alias(x)
                                             for x in ("blank", "duplicate", "truncated")])
    per = per.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(x).alias(x) for x in ("blank", "duplicate", "truncated")])
    summary = per.join(ends, "conv").select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return own.unionByName(new), summary


def digests(edits: DataFrame) -> DataFrame:
    """``(conv, audit, repaired_sha256)``. A SHA-256 runs over its text from the
    first byte to the last, so a conversation's edits pass through one task in
    order, an Arrow batch at a time; only hash state and letters are held."""
    order = ["conv", "block", "at"]
    x = edits.repartition(partitions(edits.sparkSession), "conv").sortWithinPartitions(*order)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv = None
        for f in frames:
            done = []
            for name, edit, role, text in zip(f["conv"], f["edit"], f["role"], f["text"]):
                if name != conv:
                    if conv is not None:
                        done.append((conv, "".join(audit), sha.hexdigest()))
                    conv, sha, audit, sep = name, hashlib.sha256(), [], ""
                audit.append(edit)
                if edit != "D":
                    sha.update(f"{sep}{role}:{text}".encode())
                    sep = "\n"
            yield pd.DataFrame(done, columns=names)
        if conv is not None:
            yield pd.DataFrame([(conv, "".join(audit), sha.hexdigest())], columns=names)

    names = ["conv", "audit", "repaired_sha256"]
    return x.select(*order, "edit", "role", "text").mapInPandas(run, "conv string, audit string, repaired_sha256 string")


def conversation_key(column: str = "conv_id"):
    """The id as text after ``=``; null: empty."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def damage(conversations: DataFrame) -> DataFrame:
    """Stored ``(conv, turn, role, text, uid)`` of the rows left by the damage that
    ``crc32(conv_id:turn) % 20`` picks (nulls: one space): 0 drops a row, 1
    empties its text, 2 takes its ``.!?``, 3 repeats it, 4 makes its role user."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    x = conversations.select(conversation_key().alias("conv"), F.col("turn").cast("long").alias("turn"),
                             text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    x = x.select(
        "conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return store(x.drop("copy").withColumn("uid", F.monotonically_increasing_id()), "damaged")
