"""The published English stemmer of the Snowball project (Porter's second), for
columns of lower-case words. Words of other scripts come back as they are."""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The algorithm's letters, suffixes and exceptions.
VOWELS = "aeiouy"
WHOLE = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl"} | {w: w for w in ("sky", "news", "howe", "atlas", "cosmos", "bias", "andes")}
AFTER_PLURAL = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}
LONG_STARTS = ("gener", "commun", "arsen")
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
STEP_2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al",
    "fulness": "ful", "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
}
STEP_3 = {"tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": "", "ative": ""}
STEP_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion")
LI_ENDINGS = "cdeghkmnrt"

_V, _C = f"[{VOWELS}]", f"[^{VOWELS}]"
_REGION = re.compile(f"{_V}{_C}")
_SHORT_END = re.compile(f"(?:{_C}{_V}[^{VOWELS}wxY]|^{_V}{_C})$")
_VOWEL = re.compile(_V)


def _region(word: str, start: int) -> int:
    found = _REGION.search(word, start)
    return found.end() if found else len(word)


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def _plural(w: str) -> str:
    if w.endswith("sses"):
        return w[:-2]
    if w.endswith(("ied", "ies")):
        return w[:-2] if len(w) > 4 else w[:-1]
    if w.endswith("s") and not w.endswith(("us", "ss")) and _VOWEL.search(w[:-2]):
        return w[:-1]
    return w


def _past(w: str, r1: int) -> str:
    end = _longest(w, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    if end is None:
        return w
    bare = w[: -len(end)]
    if end.startswith("eed"):
        return bare + "ee" if len(bare) >= r1 else w
    if not _VOWEL.search(bare):
        return w
    if bare.endswith(("at", "bl", "iz")):
        return bare + "e"
    if bare.endswith(DOUBLES):
        return bare[:-1]
    return bare + "e" if r1 >= len(bare) and _SHORT_END.search(bare) else bare


def _derived(w: str, r1: int, r2: int) -> str:
    end = _longest(w, STEP_2)
    if end and len(w) - len(end) >= r1:
        bare = w[: -len(end)]
        if not (end == "ogi" and not bare.endswith("l") or end == "li" and (not bare or bare[-1] not in LI_ENDINGS)):
            w = bare + STEP_2[end]
    end = _longest(w, STEP_3)
    if end and len(w) - len(end) >= (r2 if end == "ative" else r1):
        w = w[: -len(end)] + STEP_3[end]
    end = _longest(w, STEP_4)
    if end and len(w) - len(end) >= r2 and (end != "ion" or w[: -len(end)].endswith(("s", "t"))):
        w = w[: -len(end)]
    return w


@lru_cache(1 << 16)
def stem_word(word: str) -> str:
    if word in WHOLE:
        return WHOLE[word]
    if len(word) < 3:
        return word
    w = word.removeprefix("'")
    w = re.sub(f"(^|{_V})y", r"\1Y", w)
    start = next((len(p) for p in LONG_STARTS if w.startswith(p)), None)
    r1 = _region(w, 0) if start is None else start
    r2 = _region(w, r1)
    end = _longest(w, ("'", "'s", "'s'"))
    w = _plural(w[: -len(end)] if end else w)
    if w not in AFTER_PLURAL:
        w = _past(w, r1)
        w = re.sub(f"(?<=.)({_C})[yY]$", r"\1i", w)
        w = _derived(w, r1, r2)
        if w.endswith("e") and (len(w) > r2 or len(w) > r1 and not _SHORT_END.search(w[:-1])) or w.endswith("ll") and len(w) > r2:
            w = w[:-1]
    return w.replace("Y", "y")


@F.pandas_udf(StringType())
def stem(words: pd.Series) -> pd.Series:
    """Null stays null. Hand it distinct words: those of a text are counted first."""
    return words.map(stem_word, na_action="ignore")
