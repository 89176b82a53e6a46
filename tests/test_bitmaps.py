"""Distinct counts from bitmaps against sets in plain Python."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from loyaltylens.operators import bitmaps

SCHEMA = "city string, month string, member string, order_id bigint, paid boolean"


def rows(count=4000, seed=3):
    rng = random.Random(seed)
    hot = [("A", f"m{rng.randint(1, 4)}", "hot", i, True) for i in range(count // 3)]
    return hot + [
        (
            rng.choice(["A", "B", "C", None]),
            f"m{rng.randint(1, 4)}",
            rng.choice([None, f"p{rng.randint(0, 300)}"]),
            rng.randint(0, 900),
            rng.choice([True, False, None]),
        )
        for _ in range(count)
    ]


def test_numbers_are_dense_and_near(spark):
    given = spark.createDataFrame(rows(), SCHEMA)
    found = bitmaps.numbered(given, "member", "city").collect()
    numbers = {r["member"]: r["number"] for r in found}
    assert None not in numbers and sorted(numbers.values()) == list(range(1, len(found) + 1))
    home = defaultdict(list)
    for city, _, member, *_ in rows():
        if member is not None and city is not None:
            home[member].append(city)
    order = [min(home[m]) if home[m] else "" for m, _ in sorted(numbers.items(), key=lambda i: i[1])]
    assert order == sorted(order)


def test_known_ids_keep_their_numbers(spark):
    old = spark.createDataFrame([("b",), ("a",), (None,)], "id string")
    known = bitmaps.numbered(old, "id")
    first = {r["id"]: r["number"] for r in known.collect()}
    both = bitmaps.numbered(spark.createDataFrame([("c",), ("a",), ("d",), ("c",)], "id string"), "id", known=known)
    again = {r["id"]: r["number"] for r in both.collect()}
    assert first.items() <= again.items() and sorted(again.values()) == [1, 2, 3, 4] and set(again) == set("abcd")


@pytest.fixture(scope="module")
def state(spark):
    given = spark.createDataFrame(rows(), SCHEMA)
    lines = given
    for key, name in (("member", "member_number"), ("order_id", "order_number")):
        lines = bitmaps.with_number(lines, bitmaps.numbered(given, key, "city"), key, name)
    assert lines.count() == given.count()
    sets = {
        "orders": ("order_number", F.lit(True)),
        "paid_orders": ("order_number", F.col("paid")),
        "members": ("member_number", F.lit(True)),
    }
    return bitmaps.distinct_bitmaps(lines, ["city", "month"], sets)


@pytest.mark.parametrize("keys", [["city", "month"], ["city"], ["month"], []])
def test_merged_counts(state, keys):
    names = ["orders", "paid_orders", "members"]
    expected = defaultdict(lambda: (set(), set(), set()))
    for city, month, member, order, paid in rows():
        key = tuple({"city": city, "month": month}[k] for k in keys)
        expected[key][0].add(order)
        if paid:
            expected[key][1].add(order)
        expected[key][2].add(member)
    merged = bitmaps.merged(state, keys, names)
    for found in (bitmaps.distinct_counts(state, keys, names), bitmaps.distinct_counts(merged, keys, names)):
        result = {tuple(r[k] for k in keys): tuple(r[n] for n in names) for r in found.collect()}
        assert result == {k: (len(o), len(p), len(m - {None})) for k, (o, p, m) in expected.items()}


def test_rows_of_the_state_follow_the_keys_not_the_rows(state):
    """A city and month has one row per set of numbers and 32,768 ids, though a third of all rows are one member's."""
    assert state.count() <= 2 * 4 * 4


def test_nothing_to_count(spark):
    empty = spark.createDataFrame([], "city string, number bigint")
    state = bitmaps.distinct_bitmaps(empty, ["city"], {"ids": ("number", F.lit(True))})
    assert bitmaps.distinct_counts(state, ["city"], ["ids"]).collect() == []
    missing = spark.createDataFrame([("A", None)], "city string, number bigint")
    assert bitmaps.distinct_bitmaps(missing, ["city"], {"ids": ("number", F.lit(True))}).collect() == []
