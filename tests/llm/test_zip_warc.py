import io
import struct
import zipfile
from collections import Counter
from hashlib import sha256

import pytest

from weftline.llm import zip_warc

HTML = ["<p>" + "x" * 200, "<p>" + "x" * 200, "<p>" + "x" * 200, "short", "short", "", None, None, "é" * 60, "é" * 60, "日本語" * 1000]


def table():
    rows = [(i * 3 + 1, f"http://h/{i}" if i % 4 else None, h) for i, h in enumerate(HTML)]
    return [*rows, (None, "http://n/", HTML[0]), (1, "http://again/", HTML[0]), (40, "bad\r\nurl é", "y" * 100)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "x", 1) for r in table()], "page_id bigint, url string, html string, record_type string, payload int").repartition(3)


def test_round_trip(spark, pages, tmp_path, monkeypatch):
    monkeypatch.setattr(zip_warc, "ARCHIVE_BYTES", 400)
    monkeypatch.setattr(zip_warc, "SPAN_BYTES", 600)
    root = f"file://{tmp_path}/warc"
    manifest = zip_warc.write(pages, root).collect()
    assert len(manifest) > 3 and sum(r.records for r in manifest) == len(table())
    first = {}
    for i, _, h in table():
        if len((h or "").encode()) >= 100 and i is not None:
            first[h] = min(first.get(h, i), i)
    want = Counter()
    for i, _, h in table():
        raw = (h or "").encode()
        again = h in first and first[h] != i
        want[i, len(raw), sha256(raw).hexdigest(), "revisit" if again else "response", first[h] if again else None] += 1
    got = zip_warc.read(spark, root).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert all(r.payload is None if r.record_type == "revisit" else sha256(r.payload).hexdigest() == r.payload_digest for r in got)
    assert {r.url for r in got if r.page_id == 4} == {"http://h/1"}


def test_no_pages(spark, pages, tmp_path):
    root = f"file://{tmp_path}/none"
    (tmp_path / "none").mkdir()
    assert zip_warc.write(pages.limit(0), root).count() == 0
    assert zip_warc.read(spark, root).count() == 0


def reader(data):
    return lambda at, n: data[at : at + n]


def archive(force=False, comment=b"", method=zipfile.ZIP_STORED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, data in (("archive/a.warc", b"one" * 9), ("archive/b.warc", b"two"), ("indexes/index.cdxj", b"")):
            with z.open(zipfile.ZipInfo(name), "w", force_zip64=force) as f:
                f.write(data)
        z.comment = comment
    return out.getvalue()


@pytest.mark.parametrize("force", [False, True])
@pytest.mark.parametrize("comment", [b"", b"PK\x05\x06 looks like an end record" * 3])
def test_directory(force, comment):
    data = archive(force, comment)
    found = zip_warc.directory(reader(data), len(data))
    assert [(m.name, m.size) for m in found] == [("archive/a.warc", 27), ("archive/b.warc", 3), ("indexes/index.cdxj", 0)]
    start = zip_warc.data_start(reader(data), found[0])
    assert data[start : start + 27] == b"one" * 9
    assert [zip_warc.content(reader(data), m) for m in found[:2]] == [b"one" * 9, b"two"]


def test_zip64_directory():
    """A directory whose counts and offsets are all in the ZIP64 records, and an
    entry whose sizes and offset are in its extra field."""
    local = b"PK\x03\x04" + struct.pack("<HHHHHIIIHH", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 4, 20) + b"name" + struct.pack("<HHQQ", 1, 16, 5, 5) + b"hello"
    extra = struct.pack("<HH", 0x9999, 2) + b"zz" + struct.pack("<HHQQQ", 1, 24, 5, 5, 0)
    central = b"PK\x01\x02" + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 4, len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + b"name" + extra
    wide = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(central), len(local))
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, len(local) + len(central), 1)
    end = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    data = local + central + wide + locator + end
    (member,) = zip_warc.directory(reader(data), len(data))
    assert (member.name, member.size, member.header) == ("name", 5, 0)
    assert zip_warc.content(reader(data), member) == b"hello"
    broken = local + central + wide + end
    with pytest.raises(ValueError):
        zip_warc.directory(reader(broken), len(broken))


@pytest.mark.parametrize("data", [b"", b"PK", b"x" * 100_000, archive()[:-5]])
def test_damaged_files(data):
    with pytest.raises(ValueError):
        zip_warc.directory(reader(data), len(data))


def test_compressed_members_are_refused():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/a.warc", b"one" * 100)
    data = out.getvalue()
    with pytest.raises(ValueError, match="compressed"):
        list(zip_warc.entries(reader(data), zip_warc.directory(reader(data), len(data))))


def test_archive_without_index_is_scanned():
    import gzip

    records = [zip_warc.record(i, None, b"p%d" % i, sha256(b"p%d" % i).hexdigest(), None, False, str(i)) for i in range(3)]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("archive/a.warc.gz", b"".join(map(gzip.compress, records)))
        z.writestr("archive/b.warc", b"".join(records))
    data = out.getvalue()
    read = reader(data)
    pages = [zip_warc.page(*r) for at, n in zip_warc.entries(read, zip_warc.directory(read, len(data))) for r in zip_warc.parse(read(at, n))]
    assert sorted(p[0] for p in pages) == [0, 0, 1, 1, 2, 2]


def test_a_wrong_digest_is_an_error():
    data = zip_warc.record(1, None, b"payload", "0" * 64, None, False, "1")
    with pytest.raises(ValueError, match="digest"):
        [zip_warc.page(*r) for r in zip_warc.parse(data)]


def test_revisits_resolve_and_indexes_are_sorted(spark, pages, tmp_path):
    root = f"file://{tmp_path}/ids"
    names = [r.name for r in zip_warc.write(pages, root).collect()]
    ids, refers = [], []
    for name in names:
        data = (tmp_path / "ids" / name).read_bytes()
        members = zip_warc.directory(reader(data), len(data))
        for at, n in zip_warc.entries(reader(data), members):
            for headers, _ in zip_warc.parse(data[at : at + n]):
                ids.append(headers["warc-record-id"])
                refers += [headers["warc-refers-to"]] if "warc-refers-to" in headers else []
        lines = zip_warc.content(reader(data), next(m for m in members if m.name == zip_warc.INDEX)).decode().splitlines()
        assert lines == sorted(lines)
    assert refers and set(refers) <= set(ids)


def test_only_archives_of_the_manifest_are_read(spark, pages, tmp_path):
    root = f"file://{tmp_path}/stale"
    zip_warc.write(pages, root)
    folder = tmp_path / "stale"
    (folder / "part-009999-0000.wacz").write_bytes(b"left by an attempt that failed")
    (folder / "part-000000-0000.wacz.7.tmp").write_bytes(b"so is this")
    assert zip_warc.read(spark, root).count() == len(table())
    assert zip_warc.read(spark, root, payloads=False).rdd.getNumPartitions() >= 1
    (folder / "part-009999-0000.wacz").unlink()
    import shutil

    shutil.rmtree(folder / "_manifest")
    assert zip_warc.read(spark, root).count() == len(table())  # a folder of another writer


def test_sort_keys():
    assert zip_warc.sort_key("http://www.Example.com:80/A/b?Q=1#x") == "com,example)/a/b?q=1"
    assert zip_warc.sort_key("https://u@a.b.org") == "org,b,a)/" and zip_warc.sort_key(None) == zip_warc.sort_key("") == "-"
    assert " " not in zip_warc.sort_key("bad\r\nurl é")
