"""Ordered scans: long records cut into ranges against plain windows."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from weftline.operators import messages, scan

SCHEMA = "rec bigint, at bigint, role string, cost bigint"


@pytest.fixture(scope="module")
def log(spark):
    """Half of all rows belong to one record; one has no key, one row no order."""
    rng = random.Random(3)
    role = lambda: rng.choice(["user", "assistant", "tool", "tool", "system", None])
    rows = [(7, i, role(), rng.randrange(50)) for i in range(3000)]
    rows += [(rec, i, role(), rng.choice([None, 1, 2])) for rec in range(100, 400) for i in range(rng.randrange(1, 20))]
    rows += [(None, i, role(), 1) for i in range(200)] + [(7, None, "user", 5)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(6).cache()


def steps():
    return {
        "spent": scan.running_sum("cost"),
        "left": scan.running_sum("cost", backward=True),
        "call": scan.last_before(F.when(F.col("role") == "tool", F.col("at"))),
        "before": scan.previous("role"),
        "behind": scan.following("role"),
        "newest": scan.largest("at"),
        "oldest": scan.smallest("at"),
        "sum": scan.total("cost"),
    }


def windows(log):
    here, up = W.partitionBy("rec"), (W.unboundedPreceding, 0)
    on, back = here.orderBy("at"), here.orderBy(F.desc("at"))
    return log.withColumns({
        "spent": F.sum("cost").over(on.rowsBetween(*up)), "left": F.sum("cost").over(back.rowsBetween(*up)),
        "call": F.last(F.when(F.col("role") == "tool", F.col("at")), ignorenulls=True).over(on.rowsBetween(W.unboundedPreceding, -1)),
        "before": F.lag("role").over(on), "behind": F.lead("role").over(on),
        "newest": F.max("at").over(here), "oldest": F.min("at").over(here), "sum": F.sum("cost").over(here),
    })


@pytest.mark.parametrize("limit", [400, 40, 10_000])
def test_equals_windows(log, limit):
    cut = scan.ordered(log, ["rec"], ["at"], limit=limit)
    assert cut.whole == (limit == 10_000)
    found = cut.scan(**steps()).plain()
    expected = windows(log)
    assert found.columns == expected.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_no_task_gets_more_than_a_range(log):
    cut = scan.ordered(log, ["rec"], ["at"], limit=100)
    sizes = cut.rows.groupBy("rec", scan.PART).count().orderBy(F.desc("count")).collect()
    assert sizes[0]["count"] <= 100
    assert sum(r.rec == 7 for r in sizes) >= 30
    # Rows that tie in the whole order are dealt out as well.
    ties = log.withColumn("at", F.lit(1))
    assert scan.ordered(ties, ["rec"], ["at"], limit=100).rows.groupBy("rec", scan.PART).count().agg(F.max("count")).first()[0] <= 150


def test_message_operators_with_long_records(log, monkeypatch):
    rows = log.filter("at IS NOT NULL").withColumn("at", F.coalesce("rec", F.lit(0)) * 10_000 + F.col("at")).cache()

    def results():
        return [
            sorted(map(str, df.collect()))
            for df in (
                messages.tool_batches(rows, "rec", "at", "role", "tool"),
                messages.plan_segments(rows, "rec", "at", tool="user"),
                messages.budget_suffix(rows.fillna(1, ["cost"]), "rec", "at", "role", "cost", 20000),
                messages.merge_adjacent(rows, "rec", "at", "role", "role"),
                messages.last_turns(rows, "rec", "at", "role", 3),
                messages.first_exchange(rows, "rec", "at", "role", "role"),
            )
        ]

    plain = results()
    monkeypatch.setattr(scan, "RANGE", 300)
    assert results() == plain and all(plain[:4])


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert scan.ordered(empty, ["rec"], ["at"]).scan(**steps()).plain().count() == 0
