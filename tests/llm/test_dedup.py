import re
from collections import Counter
from hashlib import sha256

import pytest
import xxhash

from weftline.llm import _common, exact_dedup, mixing, simhash, suffix_dedup


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def late(doc_id):
    return (doc_id is None, doc_id or 0)


def test_exact_find(docs, table):
    got = exact_dedup.find(docs).collect()
    groups = {}
    for r in table:
        groups.setdefault(norm(r[1]), []).append(r[0])
    want = Counter()
    for text, ids in groups.items():
        first = min(ids, key=late)
        for i in ids:
            want[i, first, len(ids), sha256(text.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_drop(docs, table):
    got = exact_dedup.drop(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert sorted(norm(r.text) for r in rows) == sorted({norm(r[1]) for r in table})
    first = {}
    for r in table:
        first[norm(r[1])] = min(first.get(norm(r[1]), r[0]), r[0], key=late)
    assert all(first[norm(r.text)] == r.doc_id for r in rows)


@pytest.mark.parametrize("f", [exact_dedup.find, exact_dedup.drop, simhash.find, simhash.drop, suffix_dedup.find])
def test_empty(f, empty):
    assert f(empty).count() == 0


def test_bloom_never_misses(spark):
    keys = spark.range(3000).selectExpr("id % 2900 AS k")
    bits = _common.bloom_bits(3000)
    flagged = _common.bloom_flag(keys, ["k"], bits, _common.bloom_build(keys, ["k"], bits, least=2), "maybe")
    counts = {r["maybe"]: r["count"] for r in flagged.groupBy("maybe").count().collect()}
    assert flagged.filter("k < 100 AND NOT maybe").count() == 0
    assert counts[True] < 200 + 2800 * 0.1
    assert _common.bloom_bits(10**12) == _common.BLOOM_MAX_BITS
    assert _common.bloom_ranges(10**9) * _common.BLOOM_MAX_BITS >= 10**9 * _common.BLOOM_CELLS


def test_full_bloom_changes_nothing(docs, monkeypatch):
    want = sorted(map(str, exact_dedup.find(docs).collect()))
    monkeypatch.setattr(_common, "bloom_bits", lambda n: 64)
    assert sorted(map(str, exact_dedup.find(docs).collect())) == want


def test_ranges_keep_the_share_that_shuffles(spark, docs, monkeypatch):
    """Filters of 2048 cells, ten times as many keys: the share of unique keys
    that are taken for repeated stays as it is, and results do not change."""
    want, kept = sorted(map(str, exact_dedup.find(docs).collect())), sorted(r.text or "" for r in exact_dedup.drop(docs).collect())

    def share(n):
        keys = spark.range(n).selectExpr("id AS sha")
        parts = _common.deal_ranges(keys, "sha", n)
        return len(parts), sum(_common.maybe_repeated(p, "sha", n // len(parts)).filter("maybe").count() for p in parts) / n

    monkeypatch.setattr(_common, "BLOOM_MAX_BITS", 1 << 11)
    monkeypatch.setattr(_common, "bloom_bits", lambda n: 1 << 11)
    (few, small), (many, large) = share(128), share(1280)
    assert few == 1 and many == 10 and large < small + 0.05 < 0.15
    monkeypatch.setattr(_common, "BLOOM_MAX_BITS", 1 << 9)
    assert _common.bloom_ranges(docs.count()) > 1
    assert sorted(map(str, exact_dedup.find(docs).collect())) == want
    assert sorted(r.text or "" for r in exact_dedup.drop(docs).collect()) == kept


def test_names_that_the_operators_use_themselves(spark):
    names = ["maybe", "sha", "whole", "rank", "cell0", "words0", "bucket1", "__wl_sha", "id", "t", "stays", "size", "home", "pattern", "part", "base", "a.b", "a`c"]
    rows = [(i, f"text {i % 4}", "s", *[f"{i % 4}{n}" for n in names]) for i in range(8)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "source", *names])
    for f in (exact_dedup.drop, simhash.drop, mixing.select):
        got = f(docs)
        assert got.columns == docs.columns
        assert {tuple(r)[3:] for r in got.collect()} <= {r[3:] for r in rows}
    assert exact_dedup.drop(docs).count() == 4


def test_lookup_hot_key(spark):
    left = spark.range(20_000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id")
    right = left.groupBy("k").count()
    out = _common.lookup(left, right, "k", "count", 20_000)
    assert out.count() == 20_000 and out.filter("k = 0 AND count = 6667").count() == 6667


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def union(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_fingerprint(table):
    texts = {r[1] for r in table if r[1] is None or len(r[1]) < 20_000}
    assert all(simhash.fingerprint(t) == fingerprint(t) for t in texts)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


def test_fingerprint_in_steps(monkeypatch, table):
    text = max((r[1] or "" for r in table), key=len)
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "STEP", 1000)
    assert simhash.fingerprint(text) == whole == fingerprint(text)


def components(table):
    fps = [fingerprint(r[1]) for r in table]
    links = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    return fps, union(range(len(fps)), links)


def test_simhash_find(docs, table):
    fps, root = components(table)
    first = {}
    for i, r in enumerate(table):
        first[root[i]] = min(first.get(root[i], r[0]), r[0], key=late)
    want = Counter((r[0], f"{fps[i]:016x}", first[root[i]]) for i, r in enumerate(table))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.find(docs).collect()) == want


def test_simhash_drop(docs, table):
    _, root = components(table)
    got = simhash.drop(docs)
    assert got.columns == docs.columns
    assert got.count() == len(set(root.values()))


@pytest.mark.parametrize("crowded", [0, 64])
def test_links_reach_every_close_pair(spark, monkeypatch, crowded):
    import random

    random.seed(2)
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    centres = [random.getrandbits(64) for _ in range(6)]
    fps = {c ^ sum(1 << b for b in random.sample(range(64), random.randint(0, 3))) for c in centres for _ in range(40)}
    signed = {f: f - (1 << 64) if f >> 63 else f for f in fps}
    found = _common.components(simhash.links(spark.createDataFrame([(s,) for s in signed.values()], "fp bigint"))).collect()
    roots = {r.node: r.root for r in found}
    close = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 2]
    want = union(signed.values(), [(signed[a], signed[b]) for a, b in close])
    assert all(roots.get(s, s) == want[s] for s in signed.values())


def test_components_of_a_long_path(spark):
    path = spark.range(1, 300).selectExpr("id AS a", "id - 1 AS b")
    star = spark.range(1001, 1400).selectExpr("1000L AS a", "id AS b")
    got = {r.node: r.root for r in _common.components(path.union(star)).collect()}
    assert got == {**{i: 0 for i in range(300)}, **{i: 1000 for i in range(1000, 1400)}}


def passages(table, length=400):
    raw = [(r[1] or "").encode() for r in table]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        mask = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                mask[i : i + length] = b"\1" * length
        kept = bytes(x for x, m in zip(b, mask) if not m)
        spans = sum(1 for i, m in enumerate(mask) if m and (not i or not mask[i - 1]))
        out.append((len(b), sum(mask), spans, sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("bucket_bytes", [0, 1200, 2 << 20])
def test_passages(docs, table, monkeypatch, bucket_bytes):
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", bucket_bytes)
    monkeypatch.setattr(suffix_dedup, "SORT_BYTES", 3000)
    got = suffix_dedup.find(docs).collect()
    want = Counter((r[0], *p) for r, p in zip(table, passages(table)))
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want
    assert sum(r.n_removed for r in got) > 1000


@pytest.mark.parametrize("bucket_bytes", [3000, 2 << 20])
def test_a_passage_in_many_documents(spark, monkeypatch, bucket_bytes):
    import random

    random.seed(6)
    shared = "".join(random.choice("abcd ") for _ in range(700))
    body = lambda n: "".join(random.choice("efgh ") for _ in range(n))
    table = [(i % 70, body(random.randint(0, 300)) + shared[: random.randint(380, 700)] + body(random.randint(0, 300))) for i in range(80)]
    table += [(100 + i, shared) for i in range(40)] + [(200, "ab" * 900), (201, "ab" * 230), (None, shared), (0, shared)]
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", bucket_bytes)
    got = suffix_dedup.find(spark.createDataFrame(table, "doc_id bigint, text string")).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == Counter((r[0], *p) for r, p in zip(table, passages(table)))


def test_passages_across_blocks(spark, monkeypatch):
    import random

    random.seed(3)
    shared = "".join(random.choice("abcd ") for _ in range(900))
    body = lambda n: "".join(random.choice("efgh ") for _ in range(n))
    table = [(1, body(5000) + shared + body(100)), (2, body(33) + shared + body(7000) + shared[:450]), (3, "z" * 3000), (4, body(399))]
    monkeypatch.setattr(suffix_dedup, "BLOCK", 2000)
    got = suffix_dedup.find(spark.createDataFrame(table, "doc_id bigint, text string"), texts=True).collect()
    assert {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == {(r[0], *p) for r, p in zip(table, passages(table))}
    assert all(sha256(r.kept).hexdigest() == r.kept_sha256 and sum(s.end - s.start for s in r.spans) == r.n_removed for r in got)


@pytest.mark.parametrize("group", [1, 64, 1 << 15])
def test_refinement_by_brute_force(monkeypatch, group):
    import random

    import numpy as np

    random.seed(4)
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    for round_ in range(8):
        base = bytes(random.choice(b"ab" if round_ % 2 else b"abcdefgh") for _ in range(900))
        texts = [base, base[100:] + b"x", base[:500] + b"y" + base[500:], bytes(random.choice(b"ab") for _ in range(600)), b"a" * 450, b"short", base[31:431], b"", b"a" * 401, base[-410:], b"ab" * 300]
        random.shuffle(texts)
        mask = suffix_dedup.repeated(b"".join(texts), np.cumsum([len(t) for t in texts]))
        seen = Counter(t[i : i + 400] for t in texts for i in range(len(t) - 399))
        want = [seen[t[i : i + 400]] > 1 if i + 400 <= len(t) else False for t in texts for i in range(len(t))]
        assert mask.tolist() == want


def test_settings_of_the_session_stay(spark, docs):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    seen = []
    _common.materialize(docs.select("doc_id").mapInArrow(lambda batches: (seen.append(1) or b for b in batches), "doc_id bigint"), "rows")
    suffix_dedup.find(docs).count()
    assert spark.conf.get(key) == before
