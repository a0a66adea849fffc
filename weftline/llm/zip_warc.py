"""WARC archives packaged in ZIP files: writer and range reader.

An archive is a ZIP file with a stored member `archive/data.warc.gz` (one gzip
member a record), an index `indexes/index.cdxj` that gives each record's
offset and length in it, and `datapackage.json`. The reader parses the end
record, the ZIP64 locator and directory where there are any, and the central
directory; finds where stored members begin; reads the index; and fetches
records by byte ranges of the file. Nothing is extracted, and no archive is
read by one task alone: its index is cut into spans of some MB, and the spans
are dealt out to a number of tasks that follows from the archives' bytes.

Files are opened through pyarrow's file systems (local or mounted folders,
HDFS, S3, GCS). A task writes under a temporary name and renames; `_manifest`
lists the archives of the tasks that ended well, and where there is one, only
those are read. Other folders are listed by Spark.

Defined cases: a null html is an empty payload; a null url writes no target; a
null page_id sorts after all others and writes no page header; rows that share
the smallest page_id of equal payloads are all responses; repeated rows write
a record each; a very long html is one record, in a span of its own; an empty
table writes no archive and reads back as no rows; other columns are ignored."""

from __future__ import annotations

import gzip
import json
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import _common as C

#: Payloads below this many bytes are never revisited.
LEAST_REVISIT = 100
#: Compressed bytes at which a writer starts its next archive; bytes in a span.
ARCHIVE_BYTES, SPAN_BYTES = 128 << 20, 4 << 20
MEMBER, INDEX, MANIFEST = "archive/data.warc.gz", "indexes/index.cdxj", "_manifest"
#: Archive bytes that one task reads, about, and the most tasks.
TASK_BYTES, MAX_TASKS = 32 << 20, 100_000
DATE, STAMP = "2024-01-01T00:00:00Z", "20240101000000"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# -- writing -------------------------------------------------------------------


def identity(page_id: int | None, digest: str) -> str:
    """The record id of a response, by which revisits name it."""
    return f"<urn:page:{'none' if page_id is None else page_id}:sha256:{digest}>"


def sort_key(url: str | None) -> str:
    """The index key of a URL: host from the top domain down, path and query in
    lower case, signs outside ASCII escaped."""
    scheme, found, rest = (url or "").partition("://")
    rest = rest if found else scheme
    host, slash, path = re.match(r"([^/?#]*)(/?)([^#]*)", rest).groups()
    host = re.sub(r"^www\d*\.|:(80|443)$", "", host.rpartition("@")[2].lower())
    return quote(f"{','.join(reversed(host.split('.')))}){slash or '/'}{path.lower()}", safe="!$&'()*+,/:;=?@[]%~-._") if url else "-"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, serial: str) -> bytes:
    """One WARC record, not compressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {f'<urn:revisit:{serial}>' if revisit else identity(page_id, digest)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\r\n]+", "%0A", url))
    if page_id is not None:
        lines.append(f"WARC-Page-ID: {page_id}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {identity(refers_to, digest)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{digest}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


class ArchiveWriter:
    """Streams records into one archive; the file appears under its name only
    when it is closed."""

    def __init__(self, fs: pafs.FileSystem, path: str, attempt: int):
        self.fs, self.path, self.temporary = fs, path, f"{path}.{attempt}.tmp"
        self.stream = fs.open_output_stream(self.temporary)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(MEMBER), "w", force_zip64=True)
        self.at, self.index = 0, []

    def add(self, url: str | None, digest: str, data: bytes) -> None:
        packed = gzip.compress(data, 6, mtime=0)
        self.member.write(packed)
        entry = {"url": url, "digest": f"sha256:{digest}", "filename": MEMBER.rpartition("/")[2], "offset": self.at, "length": len(packed)}
        self.index.append(f"{sort_key(url)} {STAMP} {json.dumps(entry)}")
        self.at += len(packed)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        self.zip.writestr(INDEX, "".join(f"{line}\n" for line in sorted(self.index)))
        self.zip.writestr("datapackage.json", json.dumps({"profile": "data-package", "wacz_version": "1.1.1", "records": len(self.index)}))
        self.zip.close()
        self.stream.close()
        self.fs.move(self.temporary, self.path)
        return self.path.rpartition("/")[2], len(self.index), self.fs.get_file_info(self.path).size


def plan(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, refers_to, revisit. Payloads that may
    repeat, by a Bloom filter, are grouped by digest; the others stay where
    they are."""
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha", F.unhex(F.sha2("payload", 256)))
    long = F.octet_length("payload") >= LEAST_REVISIT
    known = C.materialize(rows.filter(long).select("page_id", "sha"), "payloads")
    n = known.count()
    bits, bitmaps = C.repeated_filter(known, "sha", n)
    firsts = C.bloom_flag(known, ["sha"], bits, bitmaps, "maybe").filter("maybe").groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    flagged = C.bloom_flag(rows, ["sha"], bits, bitmaps, "maybe")
    digest = F.lower(F.hex("sha")).alias("digest")
    nothing = [F.lit(None).cast("bigint").alias("refers_to"), F.lit(False).alias("revisit")]
    alone = flagged.filter(~(F.col("maybe") & long)).select("page_id", "url", "payload", digest, *nothing)
    found = C.lookup(C.materialize(flagged.filter(F.col("maybe") & long).drop("maybe"), "repeated"), firsts, "sha", "n", n)
    again = ~F.col("page_id").eqNullSafe(F.col("first"))
    return alone.unionByName(found.select("page_id", "url", "payload", digest, F.when(again, F.col("first")).alias("refers_to"), again.alias("revisit")))


def write(pages: DataFrame, root: str) -> DataFrame:
    """Writes archives below the folder `root`, a URI; returns the manifest:
    name, records, bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = pafs.FileSystem.from_uri(root)
        fs.create_dir(folder, recursive=True)
        task = TaskContext.get()
        part, attempt, done, writer, serial = task.partitionId(), task.taskAttemptId(), [], None, 0
        for batch in batches:
            for page_id, url, payload, digest, refers_to, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                if writer is None:
                    writer = ArchiveWriter(fs, f"{folder}/part-{part:06d}-{len(done):04d}.wacz", attempt)
                writer.add(url, digest, record(page_id, url, payload, digest, refers_to, revisit, f"{part}-{serial}"))
                serial += 1
                if writer.at >= ARCHIVE_BYTES:
                    done.append(writer.close())
                    writer = None
        if writer is not None:
            done.append(writer.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["name", "records", "bytes"])

    spark, manifest = pages.sparkSession, f"{root}/{MANIFEST}"
    plan(pages).mapInArrow(run, "name string, records bigint, bytes bigint").write.mode("overwrite").parquet(manifest)
    # What attempts that failed have left.
    fs, folder = _hadoop(spark, root)
    for status in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, "*.tmp")) or []:
        fs.delete(status.getPath(), False)
    return spark.read.parquet(manifest)


def _hadoop(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


# -- reading -------------------------------------------------------------------


@dataclass
class Member:
    name: str
    method: int
    size: int  # as stored
    header: int  # where its local header begins


def directory(read, size: int) -> list[Member]:
    """Members of a ZIP file of `size` bytes; read(offset, length) -> bytes.
    Follows the ZIP64 locator, and 64-bit sizes and offsets of entries."""
    tail_at = max(0, size - 22 - 65535)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    while end >= 0 and (len(tail) < end + 22 or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(b"PK\x05\x06", 0, end)
    if end < 0:
        raise ValueError("no end record: not a ZIP file, or cut short")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        locator = read(tail_at + end - 20, 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("the end record refers to a ZIP64 directory that is missing")
        wide = read(struct.unpack_from("<Q", locator, 8)[0], 56)
        if wide[:4] != b"PK\x06\x06":
            raise ValueError("the ZIP64 end record is damaged")
        count, length, start = struct.unpack_from("<QQQ", wide, 32)
    data, at, out = read(start, length), 0, []
    for _ in range(count):
        if data[at : at + 4] != b"PK\x01\x02":
            raise ValueError("the central directory is damaged")
        method, packed, full = struct.unpack_from("<10xH8xII", data, at)
        names, extras, comment = struct.unpack_from("<HHH", data, at + 28)
        header = struct.unpack_from("<I", data, at + 42)[0]
        name = data[at + 46 : at + 46 + names].decode("utf-8", "replace")
        extra, e = data[at + 46 + names : at + 46 + names + extras], 0
        while e + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, e)
            if kind == 1:  # only the fields that are full here are present, in this order
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, e + 4))
                full = next(wide) if full == 0xFFFFFFFF else full
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                header = next(wide) if header == 0xFFFFFFFF else header
            e += 4 + n
        out.append(Member(name, method, packed, header))
        at += 46 + names + extras + comment
    return out


def data_start(read, member: Member) -> int:
    """Where a member's bytes begin, behind its local header."""
    head = read(member.header, 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError(f"{member.name}: the local header is damaged")
    return member.header + 30 + sum(struct.unpack_from("<HH", head, 26))


def content(read, member: Member) -> bytes:
    """A small member as a whole (an index), inflated where it is deflated."""
    data = read(data_start(read, member), member.size)
    if member.method == 8:
        data = zlib.decompress(data, -15)
    elif member.method:
        raise ValueError(f"{member.name}: compression method {member.method}")
    return gzip.decompress(data) if member.name.endswith(".gz") else data


def entries(read, members: list[Member]) -> Iterator[tuple[int, int]]:
    """(offset in the file, length) of every record, by the indexes; of an
    archive member that no index names, the member as a whole."""
    archives = {m.name.rpartition("/")[2]: m for m in members if m.name.startswith("archive/") and m.name != "archive/"}
    for m in archives.values():
        if m.method:
            raise ValueError(f"{m.name} is compressed: its records can't be located")
    starts, named = {name: data_start(read, m) for name, m in archives.items()}, set()
    for m in members:
        if re.match(r"indexes/.*\.(cdxj?|idx)(\.gz)?$", m.name):
            for line in content(read, m).decode("utf-8", "replace").splitlines():
                if (brace := line.find("{")) >= 0:
                    entry = json.loads(line[brace:])
                    name = entry["filename"].rpartition("/")[2]
                    named.add(name)
                    yield starts[name] + int(entry["offset"]), int(entry["length"])
    for name in archives.keys() - named:
        yield starts[name], archives[name].size


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record in a run of gzip members or plain text."""
    while data:
        if data[:2] == b"\x1f\x8b":
            inflate = zlib.decompressobj(31)
            plain = inflate.decompress(data) + inflate.flush()
            if not inflate.eof:
                raise ValueError("a record is cut short")
            rest, data = inflate.unused_data, plain
        else:
            rest = b""
        while data:
            head, gap, body = data.partition(b"\r\n\r\n")
            first, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
            if not gap or not first.startswith("WARC/"):
                raise ValueError("no WARC record where the index has one")
            headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
            size = int(headers["content-length"])
            yield headers, body[:size]
            data = body[size + 4 :]
        data = rest


def page(headers: dict[str, str], block: bytes) -> tuple:
    """page_id, url, payload (null for a revisit), payload_bytes,
    payload_digest, record_type, refers_to."""
    number = lambda name, pattern: int(m[1]) if (m := re.search(pattern, headers.get(name, ""))) else None
    head, _, payload = block.partition(b"\r\n\r\n")
    kind, stated = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha256:")
    if kind == "revisit":
        length = int(re.search(rb"(?i)content-length: *(\d+)", head)[1])
        return number("warc-page-id", r"^(\d+|-\d+)$"), headers.get("warc-target-uri"), None, length, stated, kind, number("warc-refers-to", r"urn:page:(-?\d+)")
    if sha256(payload).hexdigest() != stated:
        raise ValueError(f"{headers.get('warc-record-id')}: the payload does not match its digest")
    return number("warc-page-id", r"^(\d+|-\d+)$"), headers.get("warc-target-uri"), payload, len(payload), stated, kind, None


def read(spark: SparkSession, root: str, payloads: bool = True) -> DataFrame:
    """All pages of the archives below `root`, as by `page`."""
    fs, folder = _hadoop(spark, root)
    if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(folder, MANIFEST)):
        files = spark.read.parquet(f"{root}/{MANIFEST}").select(F.concat(F.lit(f"{root}/"), "name").alias("path"), F.col("bytes").alias("length"))
    else:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wacz").option("recursiveFileLookup", "true").load(root).select("path", "length")

    def opened(path: str):
        fs, inner = pafs.FileSystem.from_uri(path)
        file = fs.open_input_file(inner)
        return file, lambda at, n: file.read_at(n, at)

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size in zip(*(c.to_pylist() for c in batch.columns)):
                file, at = opened(path)
                with file:
                    found = sorted(entries(at, directory(at, size)))
                rows, start = [], 0
                for i in range(1, len(found) + 1):
                    if i == len(found) or found[i][0] + found[i][1] - found[start][0] > SPAN_BYTES:
                        rows.append([x for pair in found[start:i] for x in pair])
                        start = i
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(rows), pa.string()), pa.array(rows, pa.list_(pa.int64()))], ["path", "places"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        for batch in batches:
            for path, places in zip(*(c.to_pylist() for c in batch.columns)):
                start, ends = places[0], sum(places[-2:])
                file, at = opened(path)
                with file:
                    data = at(start, ends - start)
                rows = [page(*r) for a, n in zip(places[::2], places[1::2]) for r in parse(data[a - start : a - start + n])]
                columns = list(zip(*rows))
                keep = [i for i in range(7) if payloads or i != 2]
                yield pa.RecordBatch.from_arrays([pa.array(columns[i], types[i]) for i in keep], [names[i] for i in keep])

    count, size = files.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    tasks = lambda n: max(1, min(MAX_TASKS, n))
    located = files.repartition(tasks(count), "path").mapInArrow(spans, "path string, places array<bigint>")
    schema = "page_id bigint, url string, " + "payload binary, " * payloads + "payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    # An explicit number: AQE would go by the size of the lists of offsets, not of what they name.
    spread = tasks(max(-(-size // TASK_BYTES), min(-(-size // SPAN_BYTES), spark.sparkContext.defaultParallelism)))
    return located.repartition(spread, F.col("path"), F.element_at("places", 1)).mapInArrow(fetch, schema)
