"""Documents of several formats to pages of paragraphs: rows (path, title,
page_num, paragraph, kind, text, token)."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as T
from weftline.sources import pdf, readers

PAGES = "path string, title string, page_num int, paragraph int, kind string, text string"


def _counted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("token", T.token_count(F.col("text")))


def text_pages(docs: DataFrame) -> DataFrame:
    """path, value: every line, blanks too, on one page."""
    return _counted(docs.select("path", F.lit("").alias("title"), F.lit(1).alias("page_num"), F.posexplode(F.split("value", "\n")).alias("paragraph", "text")).withColumn("kind", F.lit("text")))


def html_pages(docs: DataFrame, path: str = "path", html: str = "value", closed: bool = False) -> DataFrame:
    """Visible, cleaned, non-blank paragraphs on one page, and the title. With
    `closed`, entities count only with their semicolon."""
    paragraphs = F.filter(F.transform(F.split(T.html_to_text(F.col(html), closed), "\n"), T.clean_paragraph), lambda p: T.strip_space(p) != "")
    return _counted(docs.select(F.col(path).alias("path"), T.html_title(F.col(html)).alias("title"), F.lit(1).alias("page_num"), F.posexplode(paragraphs).alias("paragraph", "text")).withColumn("kind", F.lit("text")))


def _table(rows: list[list[str]]) -> str:
    rows = [r for r in rows if any(c for c in r)]
    if not rows:
        return ""
    keep = [i for i in range(max(map(len, rows))) if any(i < len(r) and r[i] for r in rows)]
    lines = ["|" + "|".join(str(r[i]).replace("\n", " ") if i < len(r) and r[i] is not None else "" for i in keep) + "|" for r in rows]
    return re.sub("-{6,}", "-----", "\n".join([lines[0], "|" + "---|" * len(keep), *lines[1:]]))


def _word(data: bytes) -> Iterator[tuple[int, int, str, str]]:
    """Paragraphs, then tables, of an OOXML text document, on one page."""
    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    body = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(data)).read("word/document.xml")).find(f"{w}body")
    text = lambda e: "".join(t.text or "" for t in e.iter(f"{w}t"))
    items = [("text", text(p)) for p in body.findall(f"{w}p")]
    items += [("table", _table([[text(c) for c in r.findall(f"{w}tc")] for r in t.findall(f"{w}tr")])) for t in body.findall(f"{w}tbl")]
    yield from ((1, i, kind, t) for i, (kind, t) in enumerate(items))


def _slides(data: bytes) -> Iterator[tuple[int, int, str, str]]:
    """Texts and tables of an OOXML presentation, a page a slide."""
    a = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
    archive = zipfile.ZipFile(io.BytesIO(data))
    names = sorted((n for n in archive.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n)[0]))
    for page, name in enumerate(names, 1):
        root = ElementTree.fromstring(archive.read(name))
        text = lambda e: "".join(t.text or "" for t in e.iter(f"{a}t"))
        inside = {p for t in root.iter(f"{a}tbl") for p in t.iter(f"{a}p")}
        items = [("text", text(p)) for p in root.iter(f"{a}p") if p not in inside and text(p)]
        items += [("table", _table([[text(c) for c in r.iter(f"{a}tc")] for r in t.iter(f"{a}tr")])) for t in root.iter(f"{a}tbl")]
        yield from ((page, i, kind, t) for i, (kind, t) in enumerate(items))


def _sheets(data: bytes) -> Iterator[tuple[int, int, str, str]]:
    """A Markdown table of each sheet, a page a sheet. Shared strings, numbers
    and inline strings are read from the OOXML parts."""
    s = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    archive = zipfile.ZipFile(io.BytesIO(data))
    shared = []
    if "xl/sharedStrings.xml" in archive.namelist():
        shared = ["".join(t.text or "" for t in si.iter(f"{s}t")) for si in ElementTree.fromstring(archive.read("xl/sharedStrings.xml"))]
    names = sorted((n for n in archive.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n)[0]))
    for page, name in enumerate(names, 1):
        rows = []
        for row in ElementTree.fromstring(archive.read(name)).iter(f"{s}row"):
            cells: list[str] = []
            for c in row.iter(f"{s}c"):
                letters = re.match("[A-Z]*", c.get("r", ""))[0]
                at = len(cells)
                if letters:
                    at = 0
                    for x in letters:
                        at = at * 26 + ord(x) - 64
                    at -= 1
                value = c.find(f"{s}v")
                text = "".join(t.text or "" for t in c.iter(f"{s}t")) if value is None else value.text or ""
                cells += [""] * (at - len(cells)) + [shared[int(text)] if c.get("t") == "s" else text]
            rows.append(cells)
        if table := _table(rows):
            yield page, 0, "table", table


def _delimited(data: bytes, separator: str) -> Iterator[tuple[int, int, str, str]]:
    """One table; lines with too many fields are skipped, bad bytes replaced."""
    frame = pd.read_csv(io.BytesIO(data), sep=separator, encoding_errors="replace", on_bad_lines="skip", dtype=str).fillna("")
    yield 1, 0, "table", _table([list(frame.columns), *frame.values.tolist()])


def _pdf(data: bytes) -> Iterator[tuple[int, int, str, str]]:
    yield from ((page, i, "text", text) for page, i, text in pdf.paragraphs(data))


PARSERS = {"pdf": _pdf, "docx": _word, "pptx": _slides, "xlsx": _sheets, "csv": lambda d: _delimited(d, ","), "tsv": lambda d: _delimited(d, "\t")}


def binary_pages(found: DataFrame) -> DataFrame:
    """path, kind, content to pages; a file that does not parse, or has no
    parser, gives one row of kind error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, kind, data in zip(batch["path"], batch["kind"], batch["content"]):
                try:
                    rows += [(path, "", *r) for r in PARSERS[kind](bytes(data))]
                except Exception as e:  # one bad file must not end the scan
                    rows.append((path, "", 0, 0, "error", f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "title", "page_num", "paragraph", "kind", "text"])

    return _counted(found.select("path", "kind", "content").mapInPandas(run, PAGES))


def parse(found: DataFrame) -> DataFrame:
    """All files of `readers.files` to pages, by kind."""
    as_text = found.withColumn("value", readers.decode_text(F.col("content")))
    html, plain = as_text.filter("kind = 'html'"), as_text.filter("kind IN ('txt', 'md', 'json', 'jsonl')")
    other = found.filter("kind NOT IN ('html', 'txt', 'md', 'json', 'jsonl', 'pdf')")
    printed = binary_pages(found.filter("kind = 'pdf'")).withColumn("text", F.when(F.col("kind") == "text", T.clean_paragraph(F.col("text"))).otherwise(F.col("text")))
    return binary_pages(other).unionByName(_counted(printed.drop("token"))).unionByName(html_pages(html)).unionByName(text_pages(plain))


def parse_cached(found: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(all pages, new ones): files whose path is in the cache are not parsed."""
    old = cache.join(found.select("path"), "path", "left_semi")
    new = parse(found.join(cache.select("path").distinct(), "path", "left_anti"))
    return old.unionByName(new), new
