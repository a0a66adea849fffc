import pytest
from pyspark.sql import functions as F

from weftline.functions import text as T
from weftline.plans import catalogue


@pytest.fixture(scope="module")
def ev(spark):
    def run(f, values):
        rows = spark.createDataFrame(list(enumerate(values)), "i int, s string")
        return [r.x for r in rows.select("i", f(F.col("s")).alias("x")).orderBy("i").collect()]

    return run


def test_think_variants(ev):
    texts = ["a", "<think>r</think>b", "x</think>y</think>z", "<think>only", "", None]
    assert ev(T.after_last_think, texts) == ["a", "b", "z", "<think>only", "", None]
    assert ev(T.second_think_piece, texts) == ["a", "b", "y", "<think>only", "", None]
    assert [tuple(x) for x in ev(T.think_and_answer, texts[:4])] == [("", "a"), ("r", "b"), ("", "x</think>y</think>z"), ("", "<think>only")]


def test_fences(ev):
    texts = ["```json\n{}\n```", "```\n{}\n```", "```json\n{}", "{}", "", None]
    assert ev(T.strip_fences, texts) == ["{}", "{}", "{}", "{}", "", None]
    assert ev(lambda s: T.strip_fences(s, "python"), ["```python\nx = 1\n```"]) == ["x = 1"]
    assert ev(T.strip_char_sets, ["```json{}```", "noise"]) == ["{}", "ise"]
    assert ev(T.fenced_code, ["a\n```py\nx\n```\nb", "plain"]) == ["x\n", "plain"]
    assert ev(T.last_program, ["```python\na\n```\n```python\nb\n```", "```python\nopen", "none"]) == ["b\n", "", ""]


def test_tags(ev):
    tag = lambda s: T.tag(s, "q")
    assert ev(tag, ["<q>a</q>", "<q><![CDATA[b<]]></q>", "<Q x='1'>c</Q>", "<q>open", ""]) == ["a", "b<", "", "", ""]
    assert ev(lambda s: T.tag(s, "q", loose=True), ["<Q x='1'>c</Q>", "<q>\nd\n</q>"]) == ["c", "d"]
    assert ev(lambda s: T.open_block(s, "r"), ["<r>a</r>", "<r>b <next>", "<r>c"]) == ["a", "b", "c"]
    assert ev(T.strip_comments, ["a<!-- x -->b", "<!-- open", "-->c"]) == ["ab", "open", "c"]
    assert ev(T.unwrap, ["<x>a</x>", "<x>a</y>", "a"]) == ["a", "<x>a</y>", "a"]
    assert ev(T.list_items, ["<t>a, b ,, c</t>", "a\n\n b", ""]) == [["a", "b", "c"], ["a", "b"], []]


@pytest.mark.parametrize("dimension,levels", T.RATINGS.items())
def test_ratings(ev, dimension, levels):
    rate = lambda s: T.rating(s, dimension)
    assert ev(rate, list(levels)) == list(levels.values())
    assert ev(rate, [f"  {k.upper()} " for k in levels]) == list(levels.values())
    assert ev(rate, ["", None, "zzz"]) == [None, None, None]


def test_partial_ratings_follow_the_order(ev):
    assert ev(lambda s: T.rating(s, "scenario_realism"), ["it is somewhat unrealistic", "real"]) == [1, 1]
    assert ev(lambda s: T.rating(s, "question_quality"), ["a good one", "exc"]) == [4, 5]


def test_urls(ev):
    assert ev(T.answer_urls, ["see https://a.b/c, and http://d.e/f。x", "none"]) == [["https://a.b/c", "http://d.e/f"], []]
    assert ev(T.markdown_urls, ["[t](https://a.b) [u](x)"]) == [["https://a.b"]]
    assert ev(T.basename, ["https://h/a/b%20c.pdf?x=1", "/tmp/x.txt", "https://host/", "https://host"]) == ["b c.pdf", "x.txt", "host", "host"]
    assert ev(T.url_quote, ["a b/é"]) == ["a%20b%2F%C3%A9"]


def test_language(ev):
    assert ev(T.language, ["hello", "你好世界", "你好ab", "123 !", "", None]) == ["en", "zh", "mixed", "unknown", "unknown", "unknown"]
    assert ev(lambda s: T.same_language(s, F.lit("你好")), ["hello", "你好", "1"]) == [False, True, True]
    assert ev(T.has_cjk, ["a", "a中"]) == [False, True]


def test_cleaning(ev):
    assert ev(T.clean_paragraph, ["a(cid:12)b", "x" + "0123456789abcdef01234", "a.......b", "a\n\n\n\nb"]) == ["ab", "x", "a\tb", "a\n\nb"]
    assert ev(T.join_lines, ["wo-\n", "a\nb", "中\n文", "end.\nnew", "1\n2"]) == ["wo", "a b", "中文", "end.\nnew", "1\n2"]
    assert ev(T.strip_ansi, ["\x1b[31mred\x1b[0m"]) == ["red"]
    assert ev(T.has_html_tags, ["<p>x", "a < b"]) == [True, False]
    html = "<html><title>T &amp; U</title><script>var t='</p>';</script><style>p{}</style><!-- c --><p>one</p><p>two<br>three</html>"
    assert ev(T.html_to_text, [html]) == ["T &amp; U\none\ntwo\nthree".replace("&amp;", "&")]


def test_search_tokens(ev):
    got = ev(T.search_tokens, ["The U.S.A. has 12.5% don't well-known a@b.co", "!!! the of", "", "Résumé's naïve"])
    assert got == [["u.s.a.", "12.5%", "well-known", "b.", "co"], [], [], ["résumé's", "naïve"]]


def test_token_count_and_truncation(ev):
    import re

    count_tokens = lambda s: len(re.findall(r"[一-鿿]|(?:(?![一-鿿])[^\W_])+|[^\s\w]|_", s))

    texts = ["a b, c!", "中文ab", "  x  y ", "", "a_b 1.5"]
    assert ev(T.token_count, texts) == [count_tokens(t) for t in texts] == [5, 3, 2, 0, 6]
    assert ev(T.token_count, [None]) == [0]
    assert ev(lambda s: T.truncate_tokens(s, 3), ["a b, c!", "a b"]) == ["a b,", "a b"]
    assert ev(lambda s: T.truncate_tokens(s, 2, both_sides=True), ["a b c d"]) == ["a... d"]
    assert ev(lambda s: T.middle_truncate(s, 4), ["abcdefgh", "abc"]) == ["ab...gh", "abc"]
    assert ev(lambda s: T.compact_query(s, 2), ["abcd", "abcde"]) == ["abcd", "ab\n...\nde"]
    assert ev(lambda s: T.cut_at_stop_words(s, ["Observation:"]), ["x Observation: y", "x Observation", "x"]) == ["x ", "x ", "x"]


def test_agents_texts(ev):
    got = ev(T.react_action, ["Action: a\nAction Input: 1\nx\nAction: b\nAction Input: 2\nObservation: o", "none"])
    assert [tuple(x) for x in got] == [("b", "2"), ("", "")]
    assert ev(lambda s: T.routed_agent(s, ["p", "q"]), ["Call: q\nReply: x", "Call: z", "hi"]) == ["q", "p", None]
    assert ev(T.unwrap_print, ["print(f(1))", "f(1)"]) == ["f(1)", "f(1)"]
    assert ev(T.drop_trailing_comment, ['{"a": 1} <!-- x -->', "```\nx\n``` y", "plain"]) == ['{"a": 1}', "```\nx\n```", "plain"]
    assert ev(T.drop_incomplete_marks, ["a ✿FUNC", "a ✿RESULT✿", "a"]) == ["a", "a", "a"]
    assert [tuple(x) for x in ev(T.salvage_call, ['{"name": "f", "arguments": {"a": }}', "x"])] == [("f", '{"a": }'), ("", "")]
    assert ev(T.no_answer, ["None", "there is no answer", "42", "", None]) == [True, True, False, True, True]
    assert ev(lambda s: T.fill(F.lit("a {x} {y}"), {"{x}": s, "{y}": F.lit("2")}), ["1", None]) == ["a 1 2", "a  2"]
    params = F.create_map(F.lit("ID"), F.lit("7"), F.lit("q"), F.lit("z"))
    url = ev(lambda s: T.path_template(s, params), ["/u/{id}/{other}"])[0]
    assert (url.url, url.query) == ("/u/7/{other}", {"q": "z"})
    assert ev(lambda s: T.config_url(F.lit("h"), s, F.lit("k"), F.lit("")), ["{}"]) == ["h?config=e30=&api_key=k"]
    assert ev(lambda s: T.date_line(F.to_date(s)), ["2024-01-05"]) == ["Current date: Friday, January 05, 2024"]
    assert ev(lambda s: T.date_line(F.to_date(s), "zh"), ["2024-01-05"]) == ["当前时间：2024年01月05日，星期五。"]
    assert ev(lambda s: T.html_sniff_type(s, F.lit("<p>x")), ["a.PDF?x", "b.htm", "c"]) == ["pdf", "html", "html"]


PAGES = {
    "<p>one<p>two": "one\ntwo",
    "<div>one<p>two</div>three": "onetwo\nthree",
    "a < b &amp; c &lt;b&gt;": "a < b & c <b>",
    '<a title="x > y" href=\'>\'>t</a>': "t",
    "<p it's>v</p>": "v\n",
    "x<!-- never closed <p>": "x",
    "x<!-->y<!--->z<!-- a -- b --!>w": "xyzw",
    "<script>if (a<b) '</p>'</script >z<STYLE>p{}</style>y<script>open": "zy",
    "<textarea><b>&lt;</textarea><b>c</b>": "<b><c",
    "<title>A &amp; <b>B</title>c": "A & <b>B\nc",
    "<ul><li>1<li>2</ul>3": "1\n23",
    "<table><tr><td>1<tr><td>2</table>": "1\n2",
    "&notit; &not; &copy &#128; &#x80 &apos; &CounterClockwiseContourIntegral; &unknown; &": "¬it; ¬ © € € ' ∳ &unknown; &",
    "&amp;lt; &#0; &#xD800; &nbsp;.": "&lt; � �  .",
    "&am<b>p;</b>": "&amp;",
    "a<a href='": "a",
    "</ x>y<?php z?>w<!doctype html>v": "ywv",
    "<br/>k<BR >l</p\n>m": "\nk\nl\nm",
    "": "",
    "no markup": "no markup",
}


def test_malformed_pages(ev):
    assert ev(T.html_to_text, [*PAGES, None]) == [*PAGES.values(), None]


def test_paragraphs_of_pages_with_a_cut_title(spark, tmp_path):
    """html_to_paragraphs counts as its SQL does where a title ends within an entity."""
    duckdb = pytest.importorskip("duckdb")
    pages = [(i, f"<html><title>a &amp; b{cut}</title><p>one {cut}</p><p>&lt;two&gt;<br>&amp;amp</html>") for i, cut in enumerate(("&amp", "&am", "&lt", "&#3", "&#39", "&copy", "&", ""))]
    spark.createDataFrame(pages, "page_id bigint, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = catalogue.QUERIES["html_to_paragraphs"](spark, str(tmp_path)).select("page_id", "n", "chars").collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert sorted(map(tuple, got)) == sorted(con.execute(catalogue.ORACLES["html_to_paragraphs"]).fetchall())
