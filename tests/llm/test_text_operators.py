import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from weftline.llm import cotraining, mixing, quality_rules, sentencepiece_codec, sharding, token_counts
from weftline.llm.queries import model_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_counts(table):
    assert all(quality_rules.counts(r[1])[:5] == measured(r[1]) for r in table)


def test_quality_rules(docs, table):
    got = quality_rules.judge(docs).collect()
    want = Counter((r[0], *measured(r[1])) for r in table)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality_rules.judge(docs.limit(0)).count() == 0


def test_limits_follow_the_group_and_merge(spark):
    """Sketched quartiles are within 1/32 of the exact ones; a small group uses
    its language's limits."""
    random.seed(1)
    rows = [("en", "big", "symbols", v, 1) for v in (random.randint(0, 900) for _ in range(400))] + [("en", "small", "symbols", 5, 3)]
    flat = spark.createDataFrame(rows, "lang string, source string, ratio string, value bigint, n bigint").groupBy("lang", "source", "ratio", "value").sum("n").withColumnRenamed("sum(n)", "n")
    big = quality_rules.limits(flat.filter("source = 'big'")).first()
    values = sorted(r[3] for r in rows if r[1] == "big")
    mid, high = values[199], values[299]
    assert big["size"] == 400 and abs(big.max_symbols - (high + 3 * max(high - mid, 100))) <= 1
    merged = quality_rules.limits(flat.drop("source")).first()
    assert merged["size"] == 403


def brute_verdicts(rows, prior=20, reach=3):
    """(lang, source, text) to kept, by sorted lists instead of sketches."""
    guards = {"symbols": 20, "capitals": 2, "repeats": 40, "word_length": 20, "dup_lines": 40}

    def ratios(text):
        n_words, chars, symbols, dups, repeats = measured(text)
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        capitals = sum("A" <= c <= "Z" for c in text or "")
        pairs = {"symbols": (symbols, n_words), "capitals": (capitals, chars), "repeats": (repeats, n_words), "word_length": (chars, n_words), "dup_lines": (dups, len(lines))}
        return n_words < 50 or 100 * repeats > 50 * n_words, {k: 1000 * a // max(b, 1) for k, (a, b) in pairs.items()}

    found = [(lang, source, *ratios(text)) for lang, source, text in rows]
    rough = lambda v: v >> max(0, v.bit_length() - 10) << max(0, v.bit_length() - 10)

    def limit(own, k):
        values = sorted(rough(r[3][k]) for r in own)
        at = lambda q: values[-(-len(values) * q // 4) - 1]
        return at(3) + reach * max(at(3) - at(2), guards[k])

    def drawn(own, wider, k):
        return (len(own) * limit(own, k) + prior * wider) // (len(own) + prior)

    passed = [r for r in found if not r[2]]
    limits = {}
    for lang, source in {r[:2] for r in passed}:
        for k in guards:
            in_lang, in_group = [r for r in passed if r[0] == lang], [r for r in passed if r[:2] == (lang, source)]
            limits[lang, source, k] = drawn(in_group, drawn(in_lang, limit(passed, k), k), k)
    return [not r[2] and all(r[3][k] <= limits[r[0], r[1], k] for k in guards) for r in found]


def test_verdicts_by_brute_force(spark, docs, table):
    random.seed(12)
    rows = [(r[2], r[3], r[1]) for r in table]
    for i in range(500):
        n, odd = random.randint(45, 120), random.random() < 0.1
        words = ["".join(random.choice("abcdefg") for _ in range(random.randint(2, 15 if odd else 8))) for _ in range(n)]
        words = [w.upper() if random.random() < (0.4 if odd else 0.02) else w + "#" * (odd and random.random() < 0.3) for w in words]
        text = "".join(w + random.choice("    \n") for w in words) + "same line\n" * random.choice((0, 0, 0, 1, 2, 9))
        rows.append((random.choice(["en", "de", None]), random.choice(["a", "a", "a", "b", "c", None]), text))
    got = quality_rules.judge(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id bigint, lang string, source string, text string")).collect()
    want = brute_verdicts(rows)
    assert [r.kept for r in sorted(got, key=lambda r: r.doc_id)] == want
    assert 100 < sum(want) < 480


def test_verdicts_follow_the_spread_of_the_source(spark):
    """Repeated lines, capitals and word length: what is usual in one source is
    an outlier in another."""
    random.seed(8)

    def text(capitals, letters, dup_lines):
        lines = [" ".join("abcdefghijklmnop"[random.randrange(16)] * (letters + random.randrange(2)) + str(random.randrange(10**4)) for _ in range(10)) for _ in range(20)]
        lines[20 - dup_lines :] = lines[:1] * dup_lines
        words = " ".join(["\n".join(lines)]).split(" ")
        return " ".join(w[:-1] + "Z" if i < capitals else w for i, w in enumerate(words))

    rows = []
    for i in range(200):
        rows.append((f"tight{i}", "tight", text(random.choice((4, 5)), 4, 0)))
        rows.append((f"wide{i}", "wide", text(random.randrange(40), random.choice((3, 4, 5, 6)), random.choice((0, 0, 3, 5)))))
    tests = {"capitals": text(40, 4, 0), "word_length": text(5, 6, 0), "dup_lines": text(5, 4, 5), "plain": text(5, 4, 0)}
    rows += [(name, source, t) for name, t in tests.items() for source in ("tight", "wide")]
    docs = spark.createDataFrame([(i, t, "en", s) for i, (_, s, t) in enumerate(rows)], "doc_id bigint, text string, lang string, source string")
    kept = {rows[r.doc_id][:2]: r.kept for r in quality_rules.judge(docs).collect()}
    for name in tests:
        assert kept[name, "wide"] and kept[name, "tight"] == (name == "plain"), name


def test_targets():
    got = mixing.targets([100, 1000, 10], [3, 1, 2], 1110 * 1.5)
    assert got[0] == 200 and got[2] == 20 and abs(sum(got) - 1665) < 1e-9
    assert mixing.targets([], [], 0) == [] and mixing.targets([0, 0], [3, 1], 0) == [0, 0]


def test_flow_prefers_fresh_tokens():
    """Overlap feeds both sources; nothing is repeated while fresh tokens are
    left, and the flow is the largest there is."""
    patterns = [(frozenset([0]), 100), (frozenset([0, 1]), 50), (frozenset([1]), 10)]
    flow = mixing.route(patterns, [100, 60])
    assert sum(f for (p, s), f in flow.items() if s == 0) == 100
    assert sum(f for (p, s), f in flow.items() if s == 1) == 60
    assert flow == {(0, 0): 100, (1, 1): 50, (2, 1): 10}
    flow = mixing.route(patterns, [300, 200])
    assert sum(flow.values()) == 320


def test_mixing(docs, table):
    got = mixing.mix(docs).collect()
    assert len(got) == len(table)
    size = lambda r: len(WORD.findall(r[1] or ""))
    sources = sorted({r[3] for r in table}, key=lambda s: (s is None, s or ""))
    sizes = [sum(size(r) for r in table if r[3] == s) for s in sources]
    goals = mixing.targets(sizes, [(3, 1, 2)[i % 3] for i in range(len(sources))], 1.5 * sum(sizes))
    for s, n, g in zip(sources, sizes, goals):
        own = [r for r in got if r.source == s]
        assert all(r.source_size == n and r.target == pytest.approx(g) for r in own)
        # Whole documents only: the longest one bounds how near a source can come.
        assert abs(sum(r.taken for r in own) - g) <= max(r.size for r in own) / 2 + 5
    assert all(r.taken in (0, r.size, 2 * r.size) for r in got)
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    picked = mixing.select(docs)
    assert picked.columns == docs.columns
    assert picked.count() == sum(r.copies for r in got)
    assert mixing.mix(docs.limit(0)).count() == mixing.select(docs.limit(0)).count() == 0


def test_mixing_of_overlapping_sources(spark):
    rows = [(i, "w " * 10, ["a", "b"] if i % 3 == 0 else ["a"] if i % 3 == 1 else ["b"]) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, sources array<string>")
    got = mixing.mix(docs, share=1.0, weights=(1, 1), members="sources").collect()
    assert abs(sum(r.taken for r in got) - 6000) <= 20 and all(r.copies == 1 for r in got)


def test_names_with_any_character_and_no_members(spark):
    rows = [(1, "a b c", "p\x00q", ["p\x00q"]), (2, "d e", "p", ["p", "p\x00q", "p"]), (3, "f", '["', []), (4, "g h", None, None), (5, "", "p", [None, "p"])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, members array<string>")
    plain = {r.doc_id: r for r in mixing.mix(docs).collect()}
    assert {i: (r.source, r.source_size) for i, r in plain.items()} == {1: ("p\x00q", 3), 2: ("p", 2), 3: ('["', 1), 4: (None, 2), 5: ("p", 2)}
    held = {r.doc_id: r for r in mixing.mix(docs, members="members").collect()}
    assert {i: (r.source, r.source_size) for i, r in held.items()} == {1: ("p\x00q", 5), 2: ("p", 2), 3: (None, 3), 4: (None, 3), 5: (None, 3)}
    assert mixing.select(docs, members="members").columns == docs.columns


def test_too_many_patterns_are_refused(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_PATTERNS", 3)
    with pytest.raises(ValueError):
        mixing.mix(spark.range(9).selectExpr("id AS doc_id", "'a' AS text", "CAST(id AS STRING) AS source"))


def test_flow_by_brute_force():
    """The largest flow, and of those the cheapest, over all small splits."""
    from itertools import product

    random.seed(3)
    for _ in range(30):
        patterns = [(frozenset(random.sample(range(2), random.randint(1, 2))), random.randint(1, 3)) for _ in range(3)]
        quotas = [random.randint(0, 7) for _ in range(2)]
        price = lambda tokens, flow: max(0, flow - tokens)
        best = (0, 0)
        for split in product(*[[(a, b) for a in range(2 * n + 1 if 0 in s else 1) for b in range(2 * n + 1 - a if 1 in s else 1)] for s, n in patterns]):
            if all(sum(x[i] for x in split) <= quotas[i] for i in range(2)):
                best = min(best, (-sum(map(sum, split)), sum(price(n, sum(x)) for (_, n), x in zip(patterns, split))))
        flow = mixing.route(patterns, quotas)
        through = [sum(f for (p, _), f in flow.items() if p == i) for i in range(3)]
        assert (-sum(through), sum(price(n, f) for (_, n), f in zip(patterns, through))) == best


@pytest.mark.parametrize("shards", [1, 5, 16])
def test_sharding(docs, table, shards):
    import zlib

    got = sharding.assign(docs, shards).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((r[0], size(r[1]), zlib.crc32((r[1] or "").encode())) for r in table)
    for s in range(shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert {r.shard for r in got} <= set(range(shards))
    assert sharding.assign(docs.limit(0), shards).count() == 0


def tree(points, shards, span):
    """Brute force: sorts each node by its widest dimension."""
    if shards == 1 or not points:
        return {p["doc_id"]: 0 for p in points}
    width = {d: max(p[f"k_{d}"] for p in points) - min(p[f"k_{d}"] for p in points) for d in sharding.DIMENSIONS}
    span = span or {d: max(1, w) for d, w in width.items()}
    dim = "k_" + max(sharding.DIMENSIONS, key=lambda d: width[d] / span[d])
    points = sorted(points, key=lambda p: p[dim])
    goal, at, left = sum(p["size"] for p in points) * (shards // 2) // shards, 0, 0
    while left + points[at]["size"] <= goal:
        left, at = left + points[at]["size"], at + 1
    at += 2 * (goal - left) > points[at]["size"]
    right = tree(points[at:], shards - shards // 2, span)
    return tree(points[:at], shards // 2, span) | {i: s + shards // 2 for i, s in right.items()}


@pytest.mark.parametrize("shards", [2, 7, 16])
def test_sharding_by_brute_force(spark, monkeypatch, shards):
    random.seed(9)
    rows = [(i, "é" * random.randint(0, 300), random.choice(["en", "de", None]), "src0" if i % 3 else f"src{i % 7}") for i in range(500)]
    points = sharding.points(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string"))
    monkeypatch.setattr(sharding, "points", lambda docs: points)
    got = {r.doc_id: r.shard for r in sharding.assign(points, shards).collect()}
    assert got == tree([r.asDict() for r in points.collect()], shards, None)


def test_rows_that_are_alike_are_shared_out(spark):
    alike = spark.range(1600).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'same text' AS text", "'en' AS lang", "'a' AS source", "id AS row")
    sizes = Counter(r.shard for r in sharding.assign(alike, 16).collect())
    assert sorted(sizes) == list(range(16)) and set(sizes.values()) == {100}


def test_leaves_reach_the_target(spark):
    rows = spark.range(3000).selectExpr("id AS doc_id", "repeat('x', 99) AS text", "'en' AS lang", "concat('s', id % 5) AS source")
    sizes = Counter()
    for r in sharding.assign(rows, target_bytes=14_000).collect():
        sizes[r.shard] += r["size"]
    assert len(sizes) == 22 and max(sizes.values()) <= 14_000 + 100


def test_shards_are_balanced(spark):
    random.seed(8)
    rows = [(i, "x" * random.randint(1, 400), "en", "src0" if i % 3 else f"src{i % 7}") for i in range(4000)]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string"), 16).collect()
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) < 0.02 * sum(sizes.values()) / 16 + 800


def codec(check=True):
    with open(model_path(), "rb") as f:
        return sentencepiece_codec.Codec(f.read(), check)


def test_codec_parity_and_round_trip(table):
    import sentencepiece

    own, other = codec(), sentencepiece.SentencePieceProcessor(model_file=model_path())
    random.seed(1)
    odd = ["".join(random.choice(["a", "the", " ", "  ", "\n", "é", "中", "😀", "▁", "\t", "\x00", "ing"]) for _ in range(random.randint(0, 30))) for _ in range(500)]
    texts = [r[1] for r in table] + odd + [" " * n + "a" + " " * n for n in range(20)]
    ids, agree = own.encode(texts)
    assert all(agree) and [i.tolist() for i in ids] == [other.encode(t or "") for t in texts]
    assert [i.tolist() for i in ids] == [own.whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert own.decode(ids) == [other.decode(i.tolist()) for i in ids] == [own.whole.decode(i.tolist(), skip_special_tokens=False) for i in ids]
    plain = [t or "" for t in texts if "▁" not in (t or "")]
    assert own.decode(own.encode(plain)[0]) == plain


def test_stray_bytes_decode_like_the_library():
    own = codec(False)
    ids = np.array([own.model.pieces.index("<0xE4>"), own.model.pieces.index("<0xB8>"), own.model.pieces.index("▁the")])
    assert own.decode([ids]) == [own.whole.decode(ids.tolist(), skip_special_tokens=False)]


def test_unigram_model_is_rebuilt():
    """A unigram model written field by field: Viterbi by its scores, and bytes
    for what it lacks."""
    import struct

    def field(number, value):
        return bytes([number << 3 | 2, len(value)]) + value

    def piece(text, score, kind):
        return field(1, field(1, text.encode()) + b"\x15" + struct.pack("<f", score) + bytes([3 << 3, kind]))

    pieces = [("<unk>", 0, 2), ("▁a", -1.0, 1), ("b", -1.5, 1), ("▁ab", -3.0, 1), ("▁", -2.0, 1), ("a", -2.0, 1)] + [(f"<0x{i:02X}>", -10.0, 6) for i in range(256)]
    data = b"".join(piece(*p) for p in pieces) + field(2, bytes([3 << 3, 1, 0x98, 0x02, 1])) + field(3, bytes([3 << 3, 1, 4 << 3, 0, 5 << 3, 1]))
    import sentencepiece

    own = sentencepiece_codec.Codec(data, check=False)
    other = sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["ab", "a ab b", "aé", "", "bbb a"]
    assert [i.tolist() for i in own.encode(texts)[0]] == other.encode(texts)


def test_unigram_model_with_a_charsmap():
    """A larger unigram model with the NFKC map that the library itself holds,
    and removal of spaces; its scores are invented, nothing is trained."""
    import struct

    import sentencepiece

    def varint(n):
        return bytes([n & 127 | 128]) + varint(n >> 7) if n > 127 else bytes([n])

    def field(number, value):
        return bytes([number << 3 | 2]) + varint(len(value)) + value

    random.seed(8)
    words = {"".join(random.choice("aeinrst") for _ in range(random.randint(1, 6))) for _ in range(400)} | set("aeinrst(),1fi") | {"中", "カ"}
    pieces = [("<unk>", 0.0, 2)] + [(f"<0x{i:02X}>", -30.0, 6) for i in range(256)] + [("▁", -3.3, 1)]
    pieces += [(p, round(-random.uniform(2, 12), 3), 1) for w in sorted(words) for p in (w, "▁" + w)]
    normal = dict(sentencepiece_codec._wire(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto()))[3]
    charsmap = dict(sentencepiece_codec._wire(normal))[2]
    data = b"".join(field(1, field(1, t.encode()) + b"\x15" + struct.pack("<f", x) + bytes([3 << 3, k])) for t, x, k in pieces)
    data += field(2, bytes([3 << 3, 1, 0x98, 0x02, 1])) + field(3, field(2, charsmap) + bytes([3 << 3, 1, 4 << 3, 1, 5 << 3, 1]))
    own, other = sentencepiece_codec.Codec(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    assert not own.plain and own.splits
    texts = [" ".join(random.choice(["Tea", "ＲＡＩＮ", "ｶ", "ﬁn", "① ", "strain", "é", "中", "  ", "\t", "entire", "(a)"]) for _ in range(random.randint(0, 12))) for _ in range(300)]
    ids, agree = own.encode(texts)
    exact = other.encode(texts)
    assert agree == [a.tolist() == b for a, b in zip(ids, exact)]
    assert sum(agree) >= 0.99 * len(texts)
    good = [i for i, a in enumerate(agree) if a]
    assert [own.decode([ids[i]])[0] for i in good] == [other.decode(exact[i]) for i in good]


def test_a_difference_is_flagged_and_the_ids_are_the_backends_own():
    own = codec()
    text = ["one wondrous day", "plain"]
    right = own.encode(text)[0]

    class Other:
        def encode(self, texts, **_):
            return [[1, 2, 3] if "wondrous" in t else own.whole.encode(t).ids for t in texts]

    own.known, own.older, own.reference = {}, {}, Other()
    ids, agree = own.encode(text)
    assert agree == [False, True] and all(np.array_equal(a, b) for a, b in zip(ids, right))


def test_damaged_models_are_refused():
    with pytest.raises(ValueError):
        sentencepiece_codec.parse(b"\x0a\x7fabc")


def test_encode_operator(docs, table):
    own = codec(False)
    got = sentencepiece_codec.encode(docs, model_path()).collect()
    want = Counter((r[0], tuple(own.encode([r[1]])[0][0].tolist()), sha256((r[1] or "").encode()).hexdigest()) for r in table)
    assert Counter((r.doc_id, tuple(r.ids), r.decoded_sha256) for r in got) == want
    assert all(r.agree and r.round_trip for r in got)
    assert sentencepiece_codec.encode(docs.limit(0), model_path()).count() == 0


def test_token_counts(docs, table, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK", 50)
    own = codec(False)
    lengths = [len(i) for i in own.encode([r[1] for r in table])[0]]
    hist = token_counts.histogram(docs, model_path()).cache()
    rows = token_counts.sums(hist).collect()
    assert {r.tokens for r in rows} == set(lengths)
    for r in rows:
        up, over = [x for x in lengths if x <= r.tokens], [x for x in lengths if x > r.tokens]
        assert (r.docs, r.docs_upto, r.tokens_upto, r.docs_above, r.tokens_above) == (lengths.count(r.tokens), len(up), sum(up), len(over), sum(over))
        assert r.truncated_tokens == sum(min(x, r.tokens) for x in lengths)
        assert (r.total_docs, r.total_tokens) == (len(lengths), sum(lengths))
    for r in token_counts.truncated_total(hist, [0, 17, 10**6]).collect():
        assert r.truncated_tokens == sum(min(x, r.limit) for x in lengths) and r.docs_above == sum(x > r.limit for x in lengths)
    order = sorted(lengths)
    for r in token_counts.quantiles(hist, [0.1, 0.5, 1.0]).collect():
        assert r.tokens == order[int(np.ceil(r.share * len(order))) - 1]
    none = hist.limit(0)
    assert token_counts.sums(none).count() == 0 and token_counts.truncated_total(none, [5]).first().truncated_tokens == 0
    assert token_counts.quantiles(none, [0.5]).first().tokens is None


def junk_or_prose(spark, n=400):
    random.seed(6)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(random.randint(2, 9)))
    rows, labels = [], []
    for i in range(n):
        good = i % 5 != 0
        words = [word() for _ in range(random.randint(40, 90))]
        text = " ".join(words) if good else " ".join(w + random.choice(["***", "$$$", "###"]) for w in words)
        rows.append((i, text, random.choice(["en", "fr"]), "good" if good and i % 2 else f"s{i % 4}", len(text)))
        labels.append((i, int(good), 0))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), {r[0]: r[1] for r in labels}


def test_cotraining_held_out_accuracy(spark):
    docs, labels, truth = junk_or_prose(spark)
    known = labels.filter("doc_id % 3 = 0")
    model = cotraining.fit(cotraining.views(docs, known))
    assert sum(map(sum, model.rounds)) > 0  # pseudo-labels were exchanged
    got = cotraining.score(docs, known).filter("doc_id % 3 <> 0").collect()
    assert sum(r.kept == bool(truth[r.doc_id]) for r in got) >= 0.97 * len(got)
    kept = {r.doc_id for r in cotraining.score(docs, known).filter("kept").collect()}
    again = cotraining.keep(docs, known)
    assert again.columns == docs.columns and {r.doc_id for r in again.collect()} == kept


def test_all_documents_teach(spark, monkeypatch):
    """The passes' sums against brute force over all documents without a label,
    however they are dealt out."""
    docs, labels, _ = junk_or_prose(spark)
    seen = cotraining.views(docs, labels.filter("doc_id % 4 = 0"))
    model = cotraining.fit(seen)
    free = seen.filter("quality IS NULL").collect()
    assert len(free) == 300
    weights = [[0.5, 1.0], [1.0, 0.25]]
    want = cotraining.lessons(model, model.views, cotraining._matrices([r.text_view for r in free], [r.meta_view for r in free]), weights, True)
    got = cotraining.taught(seen.filter("quality IS NULL").repartition(7), model, model.views, weights, True)
    assert all(np.allclose(a, b) for a, b in zip(got, want)) and sum(w[:2].sum() for w in want) > 0


def test_text_view_in_steps(monkeypatch):
    text = random.Random(1).randbytes(5000)
    whole = cotraining.text_view(text)
    monkeypatch.setattr(cotraining, "STEP", 700)
    assert (cotraining.text_view(text) == whole).all()
    assert not cotraining.text_view(b"").any() and len(cotraining.text_view(b"ab")) == cotraining.TEXT_WIDTH


def test_cotraining_edges(docs, table, spark):
    labels = spark.createDataFrame([(r[0], i % 2) for i, r in enumerate(table[:30])] + [(None, 1), (5, None)], "doc_id bigint, quality int")
    assert cotraining.score(docs, labels).count() == len(table)
    one = cotraining.score(docs, labels.filter("quality = 1")).collect()
    assert all(r.kept and r.score == 0.5 for r in one)
    assert cotraining.score(docs, labels.limit(0)).filter("kept").count() == len(table)
    assert cotraining.score(docs.limit(0), labels).count() == 0
    assert cotraining.keep(docs, labels.limit(0)).columns == docs.columns


def test_the_labelled_sample_is_bounded(docs, spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 41)], "doc_id bigint, quality int")
    assert cotraining.labelled(docs, labels, 7).count() == 7
