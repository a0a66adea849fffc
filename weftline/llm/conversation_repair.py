"""Repairs the structure of conversations at least cost, by A* on the edit lattice.

A node is (rows consumed, state of what was written); the states are those of
`(s?(ua)+)?`: nothing, after s, after u, after a. Edges keep a row (0), give it
the wanted role (2), delete it (3) or insert an empty message (2); a truncated
row that stays adds 1. Blank rows and duplicates can only be deleted. The
heuristic is the suffix sum of what no path can avoid: 3 a blank or duplicate,
1 a truncated row (it stays, or its deletion costs more). It is consistent, so
nodes are settled once, in the order of (cost + heuristic, audit). Two audits of
equal cost to one node are never prefixes of each other (the longer one would
have more insertions), so the least audit of a path is made of least audits and
ties end at the ASCII-least one.

A conversation of more than `limit` rows is dealt out by ranges of its turns
(`operators/scan.py`): a range gives, for each state before and after it, the
least (cost, audit), found by the same search block by block. These tables are
joined in order, which is exact for the reason above, and each range then writes
its part of the repaired text. Only the SHA-256 of the whole text, sequential by
its nature, streams through one task, which holds no more than a block of it.

Defined cases: a null conv_id is a conversation; null roles and texts are one
space, as are null parts of the damage key; null turns come first; rows that tie
on turn are in the order of role and text; conversations without rows after the
damage give zeros, an empty audit and the hash of nothing; a row of repeated
input is a duplicate; an empty table gives an empty result; other columns are
ignored, whatever their names."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm import _common as C
from weftline.operators import scan

#: What the rule of the repair says.
INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1
NOTHING, AFTER_S, AFTER_U, AFTER_A = range(4)
#: The initials that each state may write, and the state behind each.
NEXT = ({"u": AFTER_U, "s": AFTER_S}, {"u": AFTER_U}, {"a": AFTER_A}, {"u": AFTER_U})
ENDS = (NOTHING, AFTER_A)
NAMES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")

#: Rows of a conversation that one task repairs whole; rows of one search.
LIMIT, BLOCK = 100_000, 64
BLANK, DUPLICATE, CUT, SOUND = range(4)

Best = tuple[int, str] | None


def search(initials: str, faults: bytes, start: int, ends: tuple[int, ...] = ()) -> list[Best]:
    """Least (cost, audit) from `start` before the rows to each state behind
    them; None where there is no path. With `ends` the search is over at the
    first of these states, which is the best."""
    n = len(initials)
    ahead = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        ahead[i] = ahead[i + 1] + (DELETE if faults[i] <= DUPLICATE else TRUNCATED if faults[i] == CUT else 0)
    found: list[Best] = [None] * 4
    settled, heap, left = set(), [(ahead[0], "", 0, start)], 4
    while heap and left:
        f, audit, i, state = heapq.heappop(heap)
        if (i, state) in settled:
            continue
        settled.add((i, state))
        cost = f - ahead[i]
        if i == n:
            found[state], left = (cost, audit), left - 1
            if state in ends:
                break
        else:
            # Mandatory charges move from the heuristic into the cost.
            heapq.heappush(heap, (cost + DELETE + ahead[i + 1], audit + "D", i + 1, state))
            if faults[i] > DUPLICATE:
                charge = cost + (TRUNCATED if faults[i] == CUT else 0) + ahead[i + 1]
                if initials[i] in NEXT[state]:
                    heapq.heappush(heap, (charge, audit + "K", i + 1, NEXT[state][initials[i]]))
                for initial, to in NEXT[state].items():
                    if initial in NAMES and initial != initials[i]:
                        heapq.heappush(heap, (charge + REROLE, audit + "R", i + 1, to))
        for initial, to in NEXT[state].items():
            if initial in NAMES:
                heapq.heappush(heap, (f + INSERT, audit + "I", i, to))
    return found


Table = list[list[Best]]


def joined(first: Table, then: Table) -> Table:
    """The least (cost, audit) through two ranges of rows, by states."""
    out: Table = []
    for row in first:
        ways = [[(a[0] + b[0], a[1], b[1]) for a, via in zip(row, then) if a and (b := via[to])] for to in range(4)]
        least = [[w for w in some if w[0] == min(some)[0]] for some in ways]
        out.append([(some[0][0], min(a + b for _, a, b in some)) if some else None for some in least])
    return out


def tables(initials: str, faults: bytes) -> Table:
    """The table of any number of rows: blocks are searched and joined in pairs."""
    parts = [[search(initials[at : at + BLOCK], faults[at : at + BLOCK], s) for s in range(4)] for at in range(0, max(len(initials), 1), BLOCK)]
    while len(parts) > 1:
        parts = [joined(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def rewritten(rows: Iterable[tuple[str, str]], audit: str, state: int) -> Iterator[str]:
    """The lines `role:text` that the audit writes, from `state` on."""
    rows = iter(rows)
    for edit in audit:
        role, text = next(rows) if edit != "I" else ("", "")
        if edit == "D":
            continue
        if edit != "K":
            initial = next(i for i in NEXT[state] if i in NAMES)
            role = NAMES[initial]
        state = NEXT[state][role[:1]]
        yield f"{role}:{text}"


def fault(role: str, text: str, seen: bool) -> int:
    kept = text.strip(" \t\n\v\f\r")
    return BLANK if not kept else DUPLICATE if seen else SOUND if kept[-1] in ".!?" else CUT


def illegal(initials: list[str]) -> int:
    """Adjacent pairs of role initials that no conversation may have."""
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


# -- on Spark ----------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the rows as the query damages them."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    key = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    read = rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), space("role").alias("role"), space("text").alias("text"), key.alias("harm"))
    text = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("harm") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return read.filter("harm <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


_KEYS = ["conv_id", scan.PART]
_RESULT = "conv_id bigint, _part int, rows bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, cost bigint, audit string, repaired_sha256 string, paths string"
_ROWS = "conv_id bigint, _part int, role string, text string, seen boolean"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    return (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows in order, by (conv_id, part)."""
    return groupby(_rows(batches), key=lambda r: r[:2])


def _pack(table: Table) -> str:
    return "\n".join(f"{best[0]} {best[1]}" if best else "" for row in table for best in row)


def _unpack(text: str) -> Table:
    cells = [(int(x.partition(" ")[0]), x.partition(" ")[2]) if x else None for x in text.split("\n")]
    return [cells[i : i + 4] for i in range(0, 16, 4)]


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole conversations to their results; ranges of long ones to tables."""
    out: list[tuple] = []
    for (conv, part), rows in _groups(batches):
        kept, initials, faults, seen = [], [], bytearray(), set()
        for _, _, role, text, before in rows:
            mark = xxhash.xxh128_digest(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"))
            faults.append(fault(role, text, before or mark in seen))
            seen.add(mark)
            initials.append(role[:1])
            if not part:
                kept.append((role, text))
        line, marks = "".join(i or "-" for i in initials), bytes(faults)  # no role begins with what an empty one is given
        counts = (len(initials), *(faults.count(k) for k in (BLANK, DUPLICATE, CUT)), illegal(initials), initials[0], initials[-1])
        if part:
            out.append((conv, part, *counts, None, None, None, _pack(tables(line, marks))))
        else:
            short = search(line, marks, NOTHING, ENDS) if len(line) <= BLOCK else tables(line, marks)[NOTHING]
            cost, audit = min(best for best in (short[end] for end in ENDS) if best)
            text = "\n".join(rewritten(kept, audit, NOTHING))
            out.append((conv, part, *counts, cost, audit, hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(), None))
        if len(out) >= C.BATCH_ROWS:
            yield _batch(out, _RESULT)
            out = []
    if out:
        yield _batch(out, _RESULT)


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(c.split(" ") for c in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[k]) for c, k in zip(zip(*rows), kinds)], list(names))


_SLICES = "conv_id bigint, _part int, cost bigint, audit string, state int, slice string"


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tables of a long conversation's ranges, in order, to its cost and audit
    (with the first range) and each range's slice and the state before it."""
    for conv, rows in groupby(_rows(batches), key=lambda r: r[0]):
        now: list[Best] = [(0, "") if s == NOTHING else None for s in range(4)]
        steps = []  # part, and for each state behind it the state before it and the slice
        for _, part, paths in rows:
            table, then, came = _unpack(paths), [None] * 4, [None] * 4
            for to in range(4):
                ways = [(a[0] + b[0], s) for s, a in enumerate(now) if a and (b := table[s][to])]
                least = [s for cost, s in ways if cost == min(ways)[0]]
                if least:
                    s = least[0] if len(least) == 1 else min(least, key=lambda s: now[s][1] + table[s][to][1])
                    then[to], came[to] = (now[s][0] + table[s][to][0], now[s][1] + table[s][to][1]), (s, table[s][to][1])
            now = then
            steps.append((part, came))
        (cost, audit), state = min((now[end], end) for end in ENDS if now[end])
        out = []
        for k, (part, came) in reversed(list(enumerate(steps))):
            state, edits = came[state]
            out.append((conv, part, None if k else cost, None if k else audit, state, edits))
        yield _batch(out, _SLICES)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ranges, each led by its slice, to the lines they write."""
    for (conv, part), rows in _groups(batches):
        _, _, _, edits, state = next(rows)
        block, size, at = [], 0, 0
        for line in rewritten(((r[2], r[3]) for r in rows), edits, state):
            block.append(line)
            size += len(line)
            if size > 1 << 20:
                yield _batch([(conv, part, at, "\n".join(block))], _BLOCKS)
                block, size, at = [], 0, at + 1
        if block:
            yield _batch([(conv, part, at, "\n".join(block))], _BLOCKS)


_BLOCKS = "conv_id bigint, _part int, at bigint, lines string"


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of lines, in order, to the digest of each conversation."""
    for conv, some in groupby(_rows(batches), key=lambda r: r[0]):
        sha = hashlib.sha256()
        for i, row in enumerate(some):
            sha.update((("\n" if i else "") + row[3]).encode("utf-8", "surrogatepass"))
        yield _batch([(conv, sha.hexdigest())], "conv_id bigint, repaired_sha256 string")


def _dealt(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    return df.repartition(*by).sortWithinPartitions(*by, *[c for c in order if c not in by])


def _seen(rows: DataFrame) -> DataFrame:
    """Adds seen: whether an earlier range of the long conversation has the row's
    role and text. Rows shrink to one a range before they are shuffled."""
    mark = F.xxhash64("conv_id", "role", "text"), F.xxhash64("text", "role")
    marked = rows.withColumns({"_m": mark[0], "_n": mark[1]})
    keys = ["_m", "_n"]
    firsts = marked.groupBy(*keys).agg(F.min(scan.PART).alias("_first"), F.max(scan.PART).alias("_late"), F.count("*").alias("_times")).filter("_late > _first").drop("_late")
    firsts = C.materialize(firsts, "firsts")
    again = C.lookup(marked, firsts, keys, "_times", max(rows.count(), 1)).withColumn("seen", F.col(scan.PART) > F.col("_first")).drop("_first", "_times")
    hot = marked.join(firsts.select(*keys), keys, "left_anti").withColumn("seen", F.lit(False))
    return again.unionByName(hot).drop(*keys)


def repair(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """`rows`: conv_id, turn, role, text, none null but conv_id and turn. One
    row a conversation that has rows: conv_id, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256. Conversations of over `limit` rows
    are repaired range by range."""
    order = ["turn", "role", "text"]
    cut = scan.ordered(rows, ["conv_id"], order, limit or LIMIT)
    names = ["conv_id", scan.PART, *order]
    short = cut.rows.select(*names) if cut.whole else cut.rows.filter(F.col(scan.PART) == 0).select(*names)
    columns = [*_KEYS, "role", "text", "seen"]
    found = _dealt(short.withColumn("seen", F.lit(False)), ["conv_id"], order).select(*columns).mapInArrow(C.lean(_folded), _RESULT)
    result = ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    if cut.whole:
        return found.select(*result)
    long = C.materialize(_seen(cut.rows.filter(F.col(scan.PART) > 0).select(*names)), "long")
    parts = C.materialize(_dealt(long, _KEYS, order).select(*columns).mapInArrow(C.lean(_folded), _RESULT), "parts")
    slices = C.materialize(_dealt(parts.select("conv_id", scan.PART, "paths"), ["conv_id"], [scan.PART]).mapInArrow(C.lean(_chosen), _SLICES), "slices")
    heads = slices.select(*_KEYS, F.lit(0).alias("body"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.col("slice").alias("text"), "state")
    body = long.select(*_KEYS, F.lit(1).alias("body"), "turn", "role", "text", F.lit(0).alias("state"))
    lines = _dealt(heads.unionByName(body), _KEYS, ["body", *order]).select(*_KEYS, "role", "text", "state").mapInArrow(C.lean(_lines), _BLOCKS)
    digests = _dealt(C.materialize(lines, "lines"), ["conv_id"], [scan.PART, "at"]).mapInArrow(C.lean(_hashed), "conv_id bigint, repaired_sha256 string")
    edges = scan.Ordered(parts.drop("cost", "audit", "repaired_sha256", "paths").withColumn("_at", F.col(scan.PART)).withColumn(scan.PART, F.lit(0)), ["conv_id"], ["_at"], whole=True)
    linked = edges.scan(_before=scan.previous("last")).rows
    between = F.when(F.col("_before").isNotNull() & ~F.concat("_before", "first").isin(*LEGAL), 1).otherwise(0)
    sums = linked.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")], F.sum(F.col("illegal") + between).cast("bigint").alias("illegal"))
    whole = slices.filter("cost IS NOT NULL").select(F.col("conv_id").alias("_c"), "cost", "audit")
    empty = hashlib.sha256(b"").hexdigest()
    out = sums.join(whole, F.expr("conv_id <=> _c")).drop("_c").join(digests.withColumnRenamed("conv_id", "_c"), F.expr("conv_id <=> _c"), "left")
    return found.select(*result).unionByName(out.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(empty))).select(*result))


def report(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """Damages the rows and repairs them: one row for every conv_id of `rows`,
    with the gaps between its turns."""
    harmed = damaged(rows)
    gaps = harmed.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id")
    span = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint")
    gaps = gaps.agg(span.alias("gaps")).select(F.col("conv_id").alias("_g"), "gaps")
    fixed = repair(harmed, limit).withColumnRenamed("conv_id", "_r")
    every = rows.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    out = every.join(gaps, F.expr("conv_id <=> _g"), "left").join(fixed, F.expr("conv_id <=> _r"), "left")
    zero = {c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    empty = {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest()))}
    return out.withColumns(zero | empty).select("conv_id", *zero, *empty)
