"""String functions over columns: think blocks, fences, tags, ratings, URLs,
languages, cleaning, tokenising, truncation. All are built from expressions
that stay in the JVM; a null input gives null unless the docstring says
otherwise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftline.functions.html import visible_text, visible_text_closed

CJK = r"[一-鿿]"

# -- think blocks and code fences ---------------------------------------------

END_THINK = "</think>"


def after_last_think(s: Column) -> Column:
    """What follows the last end tag; the whole string without one."""
    return F.substring_index(s, END_THINK, -1)


def second_think_piece(s: Column) -> Column:
    """The piece between the first and the second end tag; the whole string
    without a tag."""
    return F.when(s.contains(END_THINK), F.split_part(s, F.lit(END_THINK), F.lit(2))).otherwise(s)


def think_and_answer(s: Column) -> Column:
    """struct(reasoning, answer) of the first block; without one the whole
    string is the answer."""
    pattern = r"(?s)<think>(.*?)</think>(.*)"
    has = s.rlike(pattern)
    return F.struct(F.when(has, F.trim(F.regexp_extract(s, pattern, 1))).otherwise("").alias("reasoning"), F.when(has, F.trim(F.regexp_extract(s, pattern, 2))).otherwise(s).alias("answer"))


def strip_space(s: Column) -> Column:
    """Trims any white space, not blanks alone."""
    return F.regexp_replace(s, r"^\s+|\s+$", "")


def strip_fences(s: Column, language: str = "json") -> Column:
    """Takes a leading fence, with or without language, and a trailing one."""
    bare = F.regexp_replace(strip_space(s), rf"^```(?:{language})?", "")
    return strip_space(F.regexp_replace(strip_space(bare), r"```$", ""))


def strip_char_sets(s: Column) -> Column:
    """Strips backquotes, then any of the letters of `json`, from both ends."""
    return F.btrim(F.btrim(s, F.lit("`")), F.lit("json"))


def fenced_code(s: Column) -> Column:
    """The first fenced block's text; without one the whole string."""
    pattern = r"(?s)```[^\n]*\n(.+?)```"
    return F.when(s.rlike(pattern), F.regexp_extract(s, pattern, 1)).otherwise(s)


def last_program(s: Column) -> Column:
    """The last ```python block; '' where it is not terminated or missing."""
    last = F.element_at(F.split(s, "```python"), -1)
    open_ = s.contains("```python") & last.contains("```")
    return F.when(open_, F.regexp_replace(F.split_part(last, F.lit("```"), F.lit(1)), r"^\n", "")).otherwise("")


# -- tags -----------------------------------------------------------------------


def tag(s: Column, name: str, loose: bool = False) -> Column:
    """Content of the first <name> tag, CDATA preferred; '' without one. With
    `loose`, in any case and with attributes."""
    flags, attributes = ("(?is)", r"\b[^>]*") if loose else ("(?s)", "")
    data = F.regexp_extract(s, rf"{flags}<{name}{attributes}>\s*<!\[CDATA\[(.*?)\]\]>\s*</{name}>", 1)
    plain = F.regexp_extract(s, rf"{flags}<{name}{attributes}>(.*?)</{name}>", 1)
    return strip_space(F.when(data != "", data).otherwise(plain))


def open_block(s: Column, name: str) -> Column:
    """Content of <name> up to its end tag or, where that is missing, the next
    tag or the end."""
    return strip_space(F.regexp_extract(s, rf"(?s)<{name}>(.*?)(?=</{name}>|<[A-Za-z_]+>|$)", 1))


def strip_comments(s: Column) -> Column:
    """Removes whole HTML comments, then stray markers, and trims."""
    whole = F.regexp_replace(s, r"(?s)<!--.*?-->", "")
    return strip_space(F.regexp_replace(F.regexp_replace(whole, "<!--", ""), "-->", ""))


def unwrap(s: Column) -> Column:
    """Takes one tag pair off that encloses the whole string."""
    return F.regexp_replace(s, r"(?s)^<(\w+)>(.*)</\1>$", "$2")


def list_items(s: Column) -> Column:
    """Names in a tool list: tags go; split at commas if there are any, else at
    newlines; trimmed, blanks dropped."""
    bare = F.regexp_replace(s, r"<[^>]+>", "")
    parts = F.when(bare.contains(","), F.split(bare, ",")).otherwise(F.split(bare, "\n"))
    return F.filter(F.transform(parts, strip_space), lambda x: x != "")


# -- ratings ----------------------------------------------------------------------

#: The levels of each dimension, in the order in which partial
#: matches are tried.
RATINGS = {
    "tool_selection_difficulty": {"very easy": 1, "easy": 2, "medium": 3, "hard": 4, "very hard": 5},
    "tool_selection_uniqueness": {"not unique": 1, "somewhat unique": 2, "moderately unique": 3, "quite unique": 4, "highly unique": 5},
    "question_quality": {"very poor": 1, "poor": 2, "average": 3, "good": 4, "excellent": 5},
    "scenario_realism": {"unrealistic": 1, "somewhat unrealistic": 2, "moderately realistic": 3, "realistic": 4, "highly realistic": 5},
}


def rating(s: Column, dimension: str) -> Column:
    """1 to 5: exact level first, then the first level that holds the text or is
    held by it; null for no text and no match."""
    text = F.lower(strip_space(s))
    levels = RATINGS[dimension].items()
    exact = [F.when(text == k, v) for k, v in levels]
    near = [F.when(text.contains(k) | F.lit(k).contains(text), v) for k, v in levels]
    return F.when(F.coalesce(s, F.lit("")) != "", F.coalesce(*exact, *near))


# -- URLs and languages -------------------------------------------------------------


def answer_urls(s: Column) -> Column:
    """URLs in an answer; full-width punctuation ends them, and they do not end
    in punctuation."""
    stop = r"\s<>\"{}|\\^`\[\]，。！？；："
    return F.regexp_extract_all(s, F.lit(rf"https?://[^{stop}]+[^{stop}.,;:!?]"), F.lit(0))


def plain_urls(s: Column) -> Column:
    return F.regexp_extract_all(s, F.lit(r"https?://\S+"), F.lit(0))


def markdown_urls(s: Column) -> Column:
    return F.regexp_extract_all(s, F.lit(r"\[[^\]]*\]\((https?://[^)\s]+)\)"), F.lit(1))


def basename(s: Column) -> Column:
    """Last path segment of a URL or path, percent-decoded; the host where the
    path is empty."""
    path = F.regexp_replace(F.regexp_replace(s, r"[?#].*$", ""), r"^[a-zA-Z][\w+.-]*://[^/]*", "")
    last = F.regexp_extract(path, r"([^/\\]*)$", 1)
    host = F.regexp_extract(s, r"^[a-zA-Z][\w+.-]*://([^/?#]*)", 1)
    name = F.when(last != "", last).otherwise(host)
    return F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)


def url_quote(s: Column) -> Column:
    """Percent-encoding with %20 for a blank."""
    return F.replace(F.url_encode(s), F.lit("+"), F.lit("%20"))


def has_cjk(s: Column) -> Column:
    return s.rlike(CJK)


def language(s: Column) -> Column:
    """zh: over 0.6 of the letters are CJK; en: over 0.7 are others; else
    mixed; unknown without letters. Null counts as empty."""
    text = F.coalesce(s, F.lit(""))
    han = F.length(F.regexp_replace(text, r"[^一-鿿]", ""))
    other = F.length(F.regexp_replace(F.regexp_replace(text, CJK, ""), r"\P{L}", ""))
    n = han + other
    return F.when(n == 0, "unknown").when(han > 0.6 * n, "zh").when(other > 0.7 * n, "en").otherwise("mixed")


def same_language(query: Column, answer: Column) -> Column:
    """Unknown passes."""
    a, b = language(query), language(answer)
    return (a == "unknown") | (b == "unknown") | (a == b)


# -- cleaning --------------------------------------------------------------------------


def clean_paragraph(s: Column) -> Column:
    """Drops (cid:n) marks and runs of 21 or more hex digits; runs of seven or
    more placeholders become a tab; three or more newlines two."""
    # What counts as a mark, a hex run or a placeholder.
    steps = [(r"\(cid:\d+\)", ""), (r"[0-9A-Fa-f]{21,}", ""), (r"[.\- —。_*]{7,}", "\t"), (r"\n{3,}", "\n\n")]
    return reduce(lambda x, step: F.regexp_replace(x, *step), steps, s)


def join_lines(s: Column) -> Column:
    """A trailing hyphen and newline go; newlines not after a stop, colon or
    digit become a blank (nothing in CJK text)."""
    gap = F.when(has_cjk(s), F.lit("")).otherwise(F.lit(" "))
    joined = F.regexp_replace(s, F.lit(r"(?<=[^.。:：\d])\n"), gap)
    return strip_space(F.when(s.endswith("-\n"), F.regexp_replace(s, r"-\n\z", "")).otherwise(joined))


def strip_ansi(s: Column) -> Column:
    return F.regexp_replace(s, r"\u001b(?:[@-Z\\-_]|\[[0-?]*[ -/]*[@-~])", "")


def has_html_tags(s: Column) -> Column:
    return s.rlike(r"(?i)<(p|span|div|li|html|script)[^>]*?")


def html_to_text(html: Column, closed: bool = False) -> Column:
    """Visible text of a page, however malformed: see `functions/html.py`. With
    `closed`, entities count only with their semicolon."""
    return visible_text_closed(html) if closed else visible_text(html)


def html_title(html: Column) -> Column:
    return strip_space(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


# -- tokens ---------------------------------------------------------------------------------

#: Words that searches ignore, in the order they were published; the
#: punctuation among them is in PUNCTUATION.
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his himself
she she's her hers herself it it's its itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did doing a an the and but if or because as
until while of at by for with about against between into through during before after above below to from up down in
out on off over under again further then once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don don't should should've now d ll m o re ve y ain
aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn
mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
的 吗 是 了 啊 呢 怎么 如何 什么 讲了 描述 讲 总结 summarize 总结下 总结一下 文档 文章 article paper 文稿 稿子 论文 PDF pdf
这个 这篇 这 我 帮我 那个 下 翻译 说说 讲讲 介绍 summary
""".split()
#: What is stripped from tokens, and what alone is no token.
PUNCTUATION = "!\"#$&'()*+,-/:;<=>?[\\]^_`{|}~。？！，、；：“”‘’（）《》【】……—『』「」_"

TOKEN = r"(?U)(?:[A-Za-z]\.)+|\d+(?:\.\d+)?%?|\w+(?:[-']\w+)*|(?:[\w\-']@)+\w+"
_SPECIAL = r"(?U)^(?:(?:[A-Za-z]\.)+|\w+@\w+\.\w+|\d+%$|[一-鿿]+$)"


def raw_tokens(s: Column) -> Column:
    """Abbreviations, numbers and percentages, words with inner - or ', e-mail
    addresses, in lower case."""
    return F.regexp_extract_all(strip_space(F.lower(s)), F.lit(TOKEN), F.lit(0))


def word_pieces(s: Column) -> Column:
    """`raw_tokens`; of texts with Chinese, also the pairs of neighbours in each
    run of Chinese signs, and signs that stand alone, in place of whole runs.
    Pairs need no dictionary, and find every word of two signs or more."""
    pairs = F.regexp_extract_all(s, F.lit(r"(?=([一-鿿]{2}))"), F.lit(1))
    alone = F.regexp_extract_all(s, F.lit(r"(?<![一-鿿])[一-鿿](?![一-鿿])"), F.lit(0))
    return F.when(has_cjk(s), F.concat(raw_tokens(F.regexp_replace(s, r"[一-鿿]+", " ")), pairs, alone)).otherwise(raw_tokens(s))


def clean_token(t: Column) -> Column:
    """A raw token without punctuation around it; special cases stay."""
    return F.when(t.rlike(_SPECIAL), t).otherwise(F.btrim(t, F.lit(PUNCTUATION)))


def is_term(t: Column) -> Column:
    """Whether a clean token is no stop word and more than punctuation."""
    return (t != "") & ~t.isin(STOP_WORDS) & (F.btrim(t, F.lit(PUNCTUATION)) != "")


def search_tokens(s: Column) -> Column:
    """Clean search terms, in order within a script; repeats stay. Not stemmed.
    To count terms of many texts, explode `word_pieces` first: then the rest is
    compiled."""
    return F.filter(F.transform(word_pieces(s), clean_token), is_term)


#: The default token counter: runs of letters and digits, single CJK
#: characters, and single other signs. Deterministic, and needs no vocabulary.
COUNTED = r"(?U)[一-鿿]|[\p{L}\p{N}&&[^一-鿿]]+|[^\s\p{L}\p{N}]"


def token_count(s: Column) -> Column:
    return F.regexp_count(F.coalesce(s, F.lit("")), F.lit(COUNTED))


def spaced_tokens(s: Column) -> Column:
    """The tokens, each with the space before it."""
    return F.regexp_extract_all(s, F.lit(r"(?U)\s*(?:" + COUNTED[4:] + ")"), F.lit(0))


def truncate_tokens(s: Column, limit: Column | int, both_sides: bool = False) -> Column:
    """The first `limit` tokens with the space between them; with `both_sides`
    the first and last halves around '...'."""
    limit = F.lit(limit) if isinstance(limit, int) else limit
    tokens = spaced_tokens(s)
    n, half = F.size(tokens), F.floor(limit / 2).cast("int")
    cut = lambda start, length: F.array_join(F.slice(tokens, start, length), "")
    head = cut(F.lit(1), F.greatest(limit, F.lit(0)))
    if both_sides:
        head = F.when(half > 0, F.concat(cut(F.lit(1), half), F.lit("..."), cut(n - half + 1, half))).otherwise("...")
    return F.when(n <= limit, s).otherwise(head)


def middle_truncate(s: Column, limit: int = 256) -> Column:
    """Both halves around '...' where the text is longer than `limit`."""
    half = limit // 2
    return F.when(F.length(s) > limit, F.concat(F.left(s, F.lit(half)), F.lit("..."), F.right(s, F.lit(half)))).otherwise(s)


def compact_query(s: Column, limit: int) -> Column:
    """Texts up to twice the limit stay; longer ones keep head and tail."""
    return F.when(F.length(s) <= 2 * limit, s).otherwise(F.concat(F.left(s, F.lit(limit)), F.lit("\n...\n"), F.right(s, F.lit(limit))))


def cut_at_stop_words(s: Column, stop: list[str], partial: list[str] | None = None) -> Column:
    """Ends before the first of each stop word in turn; then drops one trailing
    partial stop word (the words without their last sign, unless given)."""
    text = reduce(lambda x, w: F.substring_index(x, w, 1), stop, s)
    for p in sorted({w[:-1] for w in stop if len(w) > 1} if partial is None else set(partial)):
        text = F.when(text.endswith(p), F.left(text, F.length(text) - len(p))).otherwise(text)
    return text


# -- agents' texts ------------------------------------------------------------------------


def react_action(s: Column) -> Column:
    """struct(action, action_input) by the last Action line; empty without one."""
    pattern = r"(?s).*\nAction:(.*)\nAction Input:(.*?)(?:\nObservation:.*|$)"
    text = F.concat(F.lit("\n"), s)
    return F.struct(strip_space(F.regexp_extract(text, pattern, 1)).alias("action"), strip_space(F.regexp_extract(text, pattern, 2)).alias("action_input"))


def routed_agent(s: Column, agents: list[str]) -> Column:
    """The name after the last `Call:`, if it is known; else the first agent.
    Without a call, null."""
    name = strip_space(F.split_part(F.substring_index(s, "Call:", -1), F.lit("\n"), F.lit(1)))
    return F.when(s.contains("Call:"), F.when(name.isin(agents), name).otherwise(agents[0]))


def unwrap_print(s: Column) -> Column:
    """print(x) -> x"""
    return F.regexp_replace(strip_space(s), r"(?s)^print\((.+)\)$", "$1")


def drop_trailing_comment(s: Column) -> Column:
    """What follows the last } of an object, or the closing fence, goes."""
    text = strip_space(s)
    return F.when(text.rlike(r"(?s)^\{.*\}"), F.regexp_extract(text, r"(?s)^.*\}", 0)).when(text.rlike(r"(?s)^```.*\n```"), F.regexp_extract(text, r"(?s)^.*\n```", 0)).otherwise(text)


#: The special tokens of the marker dialect.
MARKS = ("✿FUNCTION✿", "✿ARGS✿", "✿RESULT✿", "✿RETURN✿")


def drop_incomplete_marks(s: Column) -> Column:
    """A special token, or the beginning of one, at the end of the text goes."""
    starts = sorted({m[:n] for m in MARKS for n in range(1, len(m) + 1)}, key=len, reverse=True)
    text = F.regexp_replace(s, r"\s+$", "")
    cut = F.regexp_replace(text, "(?:" + "|".join(starts) + r")\z", "")
    return F.regexp_replace(F.regexp_replace(cut, r"^\n+", ""), r"\s+$", "")


def salvage_call(s: Column) -> Column:
    """struct(name, arguments) of a call whose JSON is broken."""
    name = F.regexp_extract(s, r'(?s)^.+?"name": "(.*?)", "', 1)
    arguments = strip_space(F.regexp_extract(s, r'(?s)^.+?"arguments": (.*)$', 1))
    return F.struct(name.alias("name"), F.when(F.length(arguments) > 2, F.left(arguments, F.length(arguments) - 1)).otherwise("").alias("arguments"))


def no_answer(s: Column) -> Column:
    """Whether a reply says that there is nothing to be found, or is blank."""
    text = F.regexp_replace(F.lower(F.coalesce(s, F.lit(""))), r"[\s.。!！\"'`{}:]+", "")
    return text.isin("", "none", "resnone", "\"res\"none") | text.contains("noanswer") | text.contains("无法回答")


def fill(template: Column, values: dict[str, Column]) -> Column:
    """Literal placeholders replaced one after the other."""
    return reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.coalesce(kv[1], F.lit(""))), values.items(), template)


def path_template(template: Column, params: Column) -> Column:
    """struct(url, query): {name} parts take the parameter of that name in any
    case; parameters that no part takes are left for the query string."""
    names = F.transform(F.regexp_extract_all(template, F.lit(r"\{(\w+)\}"), F.lit(1)), F.lower)
    low = F.map_from_entries(F.transform(F.map_entries(params), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))))
    parts = F.regexp_extract_all(template, F.lit(r"\{(\w+)\}"), F.lit(1))
    url = F.aggregate(parts, template, lambda acc, p: F.replace(acc, F.concat(F.lit("{"), p, F.lit("}")), F.coalesce(F.try_element_at(low, F.lower(p)), F.concat(F.lit("{"), p, F.lit("}")))))
    return F.struct(url.alias("url"), F.map_filter(params, lambda k, v: ~F.array_contains(names, F.lower(k))).alias("query"))


def config_url(base: Column, config: Column, api_key: Column, profile: Column) -> Column:
    """A server URL with its configuration as base64 JSON, a key, and a profile
    where there is one."""
    url = F.concat(base, F.lit("?config="), F.base64(F.encode(config, "UTF-8")), F.lit("&api_key="), api_key)
    return F.when(F.coalesce(profile, F.lit("")) != "", F.concat(url, F.lit("&profile="), profile)).otherwise(url)


def date_line(day: Column, lang: str = "en") -> Column:
    """The current-date line of a prompt."""
    if lang == "zh":
        weekday = F.element_at(F.array(*map(F.lit, "一二三四五六日")), F.weekday(day) + 1)
        return F.concat(F.lit("当前时间："), F.date_format(day, "yyyy'年'MM'月'dd'日，星期'"), weekday, F.lit("。"))
    return F.concat(F.lit("Current date: "), F.date_format(day, "EEEE, MMMM dd, yyyy"))


def html_sniff_type(path: Column, content: Column) -> Column:
    """File type by extension; else html where the content has tags; else txt."""
    extension = F.lower(F.regexp_extract(F.regexp_replace(path, r"[?#].*$", ""), r"\.([A-Za-z0-9]+)$", 1))
    known = extension.isin("pdf", "docx", "pptx", "txt", "html", "csv", "tsv", "xlsx", "xls", "json", "jsonl", "md")
    return F.when(known, extension).when(extension == "htm", "html").when(has_html_tags(content), "html").otherwise("txt")
