"""A small table with every awkward case the operators promise to handle."""

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, SIZE int, taken double, part string, `order` string, q int, score string"


def rows():
    random.seed(5)
    word = lambda: "".join(random.choice("abcdeéñß") for _ in range(random.randint(1, 9)))
    prose = [" ".join(word() for _ in range(random.randint(60, 200))) for _ in range(40)]
    near = prose[0].split(" ")
    near = " ".join([*near[:30], "zzz", *near[31:]])
    texts = [
        *prose,
        prose[3], prose[3], prose[3],  # copies
        prose[4].replace(" ", "\n", 5), prose[4] + "", "  ".join(prose[5].split(" ")),  # copies but for white space
        near,
        prose[6] + "\n" + prose[7],  # passages that repeat
        "x y", "x", "", " \t\n", None, None,
        "\x85a b\xa0c \x1cd",  # white space that separates no words
        "Und " * 300, "### $$$ *** " * 40, "SHOUT!! " * 90,
        " ".join(word() for _ in range(60_000)),  # very long
        "long word " + "w" * 5000,
        "日本語 テスト 😀 " * 30,
    ]
    out = [(i + 1, t, random.choice(["en", "fr", None]), random.choice(["src0", "src0", "src1", "src2", None]), None if t is None else len(t)) for i, t in enumerate(texts)]
    out += [out[2], out[2]]  # repeated rows
    out += [(None, prose[8], "en", "src1", 5), (None, prose[8], "en", "src1", 5), (None, None, None, None, None)]
    out += [(7, prose[9] + " other", "en", "src0", 9)]  # an id that is there with another text
    return [(*r, "no", -1, 0.5, "p", "o", 3, "s") for r in out]


@pytest.fixture(scope="session")
def table():
    return rows()


@pytest.fixture(scope="session")
def docs(spark, table):
    return spark.createDataFrame(table, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
