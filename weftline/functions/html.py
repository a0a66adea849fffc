"""Visible text of HTML as a parser reads it, in Arrow batches."""

from __future__ import annotations

import re
from html import unescape

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

#: A comment (also an unclosed one), a declaration, or a tag. Quotes count only
#: behind an equals sign, where they may hold `>`; what is never closed ends with the text.
_MARKUP = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))
    | <(?:[!?]|/(?![a-zA-Z]))[^>]*(?:>|\Z)
    | <(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?:=\s*"[^"]*(?:"|\Z) | =\s*'[^']*(?:'|\Z) | [^>])*(?:>|\Z)""",
    re.S | re.X,
)
#: Elements whose content is no markup: none of it is seen, or all of it as text.
_HIDDEN, _PLAIN = {"script", "style", "iframe", "noembed", "noframes", "template"}, {"textarea", "title", "xmp", "plaintext"}
#: Ends of these begin a new line.
_LINES = {"p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "title", "tr"}
#: Starts of these end an open element of the same set without its end tag.
_IMPLIED = ({"li"}, {"tr"}, {"dt", "dd"}, {"option"})
#: Starts of these end an open paragraph.
_BLOCKS = _LINES - {"title", "tr"} | {"address", "article", "aside", "blockquote", "center", "details", "dl", "fieldset", "figure", "footer", "form", "header", "hr", "main", "nav", "ol", "pre", "section", "table", "ul"}


#: An entity that its semicolon closes.
_CLOSED = re.compile(r"&(?:[a-zA-Z][a-zA-Z0-9]*|#[0-9]+|#[xX][0-9a-fA-F]+);")


def _decoded(text: str, closed: bool) -> str:
    return _CLOSED.sub(lambda m: unescape(m[0]), text) if closed else unescape(text)


def visible(html: str, closed: bool = False) -> str:
    """Scripts, styles and comments go with their content; tags go; entities are
    decoded, with or without a semicolon (`closed`: only with one), a hard blank as a
    blank; line breaks and ends of blocks, implied ones too, begin a new line; runs of
    newlines are one."""
    out, at, opened = [], 0, set()
    while m := _MARKUP.search(html, at):
        out.append(html[at : m.start()])
        at, name = m.end(), (m["name"] or "").lower()
        if m["end"]:
            opened.discard(name)
            out.append("\n" if name in _LINES else "\0")
            continue
        out.append("\n" if name == "br" else "\0")
        if name in _HIDDEN or name in _PLAIN:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            if name in _PLAIN:
                out += [html[at : end.start() if end else len(html)], "\n" if name in _LINES else "\0"]
            at = end.end() if end else len(html)
        elif name in _BLOCKS and "p" in opened:
            opened.discard("p")
            out.append("\n")
        for kind in _IMPLIED:
            if name in kind:
                out.append("\n" if opened & kind else "\0")
                opened -= kind
        opened.add(name)
    out.append(html[at:])
    # An entity does not reach across a tag: the mark between parts, which no text may hold, ends it.
    text = "\0".join(part.replace("\0", "�") if part != "\0" else "" for part in out)
    return re.sub("\n+", "\n", "".join(_decoded(part, closed) for part in text.split("\0")).replace("\xa0", " "))


@pandas_udf(StringType())
def visible_text(html: pd.Series) -> pd.Series:
    return html.map(visible, na_action="ignore")


@pandas_udf(StringType())
def visible_text_closed(html: pd.Series) -> pd.Series:
    return html.map(lambda s: visible(s, closed=True), na_action="ignore")


@pandas_udf(StringType())
def entities(text: pd.Series) -> pd.Series:
    """All named, decimal and hexadecimal entities of text without markup."""
    return text.map(lambda s: unescape(s).replace("\xa0", " ") if "&" in s else s, na_action="ignore")
