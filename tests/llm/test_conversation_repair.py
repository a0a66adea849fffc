"""Conversation repair against dynamic programming over all edits."""

import hashlib
import random
import zlib
from itertools import product

import pytest

from weftline.llm import conversation_repair as R

SCHEMA = "conv_id bigint, turn bigint, role string, text string, audit string, COST int"


def brute(initials, faults):
    """Least (cost, audit) by trying every sequence of edits."""
    best = {(0, R.NOTHING): (0, "")}
    for i in range(len(initials) + 1):
        for _ in range(3):  # no best path inserts more at one place
            for s in range(4):
                if (i, s) in best:
                    for initial, to in R.NEXT[s].items():
                        if initial != "s":
                            way = (best[i, s][0] + 2, best[i, s][1] + "I")
                            best[i, to] = min(best.get((i, to), way), way)
        if i == len(initials):
            break
        for s in range(4):
            if (i, s) not in best:
                continue
            cost, audit = best[i, s]
            ways = [((i + 1, s), (cost + 3, audit + "D"))]
            if faults[i] > R.DUPLICATE:
                charge = cost + (faults[i] == R.CUT)
                ways += [((i + 1, to), (charge, audit + "K")) for initial, to in R.NEXT[s].items() if initial == initials[i]]
                ways += [((i + 1, to), (charge + 2, audit + "R")) for initial, to in R.NEXT[s].items() if initial in "ua"]
            for node, way in ways:
                best[node] = min(best.get(node, way), way)
    return min(best[len(initials), s] for s in R.ENDS if (len(initials), s) in best)


def test_search_finds_the_least_edits():
    for n in range(5):
        for initials in product("uasx", repeat=n):
            faults = bytes(random.Random(str(initials)).choices([R.BLANK, R.DUPLICATE, R.CUT, R.SOUND], [1, 1, 2, 4], k=n))
            found = R.search("".join(initials), faults, R.NOTHING)
            assert min(found[s] for s in R.ENDS if found[s]) == brute(initials, faults)
            early = R.search("".join(initials), faults, R.NOTHING, R.ENDS)
            assert min(early[s] for s in R.ENDS if early[s]) == brute(initials, faults)


def test_blocks_join_to_the_same(monkeypatch):
    rng = random.Random(1)
    for n in (1, 5, 40, 150):
        initials, faults = "".join(rng.choices("uuaasx", k=n)), bytes(rng.choices(range(4), k=n))
        whole = [R.search(initials, faults, s) for s in range(4)]
        for block in (1, 3, 64):
            monkeypatch.setattr(R, "BLOCK", block)
            assert R.tables(initials, faults) == whole
        assert min(whole[0][s] for s in R.ENDS if whole[0][s]) == brute(initials, faults)


def expected(rows):
    """The whole report in plain Python."""
    convs, out = {}, {}
    for conv, turn, role, text, *_ in rows:
        space = lambda x: " " if x is None else str(x)
        harm, role, text = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20, space(role), space(text)
        text = "" if harm == 1 else "".join(c for c in text if c not in ".!?") if harm == 2 else text
        convs.setdefault(conv, []).extend([(turn, "user" if harm == 4 else role, text)] * (0 if harm == 0 else 2 if harm == 3 else 1))
    for conv, found in convs.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in found:
            faults.append(R.fault(role, text, (role, text) in seen))
            seen.add((role, text))
        initials = [r[1][:1] for r in found]
        cost, audit = brute([i or "-" for i in initials], faults)
        turns = [r[0] for r in found if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        text = "\n".join(R.rewritten(((r[1], r[2]) for r in found), audit, R.NOTHING))
        out[conv] = (gaps, *(faults.count(k) for k in (R.BLANK, R.DUPLICATE, R.CUT)), R.illegal(initials), cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


@pytest.fixture(scope="module")
def talk(spark):
    rng = random.Random(4)
    role = lambda: rng.choice(["user", "assistant", "assistant", "system", "tool", "", None])
    text = lambda: rng.choice(["Fine.", "what", "", None, " \t\n", "Yes!", "x" * 3000 + "?", "é über. ", "so\x85", f"t{rng.random()}.", f"t{rng.random()}"])
    rows = [(conv, turn, role(), text()) for conv in range(60) for turn in range(rng.randrange(1, 9))]
    rows += [(777, turn, ["user", "assistant"][turn % 2] if rng.random() < 0.8 else role(), f"line {rng.randrange(400)}" + rng.choice([".", "", "!"])) for turn in range(900)]  # long
    rows += [(None, 3, "user", "a."), (None, None, None, None), (5, 2, "user", "same."), (5, 2, "user", "same."), (5, None, "system", "s.")]
    rows = [(*r, "x", 1) for r in rows]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.mark.parametrize("limit", [None, 200])
def test_report(talk, limit):
    rows, df = talk
    found = R.report(df, limit).collect()
    columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r.conv_id: tuple(r[c] for c in columns) for r in found} == expected(rows) and len(found) == len({r[0] for r in rows})


def test_all_dropped_and_empty(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    found = R.report(spark.createDataFrame([(gone, 0, "user", "hi.", "", 0)], SCHEMA)).collect()
    assert [tuple(r) for r in found] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert R.report(spark.createDataFrame([], SCHEMA)).count() == 0
