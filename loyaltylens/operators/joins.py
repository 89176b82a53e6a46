"""Join helpers that keep large and skewed inputs safe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_join(
    facts: DataFrame, lookup: DataFrame, on: dict[str, str], *, how: str = "left", tasks_per_key: int = 1
) -> DataFrame:
    """Join facts to a lookup; ``on`` maps fact columns to lookup columns, which are dropped.

    A plain equi-join, so nothing runs while a report is built.  Spark broadcasts the lookup if its size, known or
    measured at run time, is small, and else shuffles both sides and splits partitions that turn out too large.

    Facts that a left join keeps although their key is missing get stand-ins, so that they spread over all tasks.  With
    ``tasks_per_key`` the facts of every key are dealt to so many tasks and the lookup is repeated for each: for a small
    lookup where one key may hold most facts and the engine does not split partitions.
    """
    keys = {right: f"_lookup_{right}" for right in on.values()}
    others, kinds = lookup.withColumnsRenamed(keys), dict(facts.dtypes)
    condition = F.lit(True)
    for left, right in on.items():
        key = F.col(left)
        if how == "left" and kinds.get(left) == "string":
            # The stand-in of a missing key holds characters of a private area before its number.
            key = F.coalesce(key, F.concat(F.lit("\ue000missing "), F.xxhash64(*facts.columns).cast("string")))
        condition = condition & (key == F.col(keys[right]))
    drop = list(keys.values())
    if tasks_per_key > 1:
        facts = facts.withColumn("_part", F.pmod(F.xxhash64(*facts.columns), F.lit(tasks_per_key)))
        parts = F.array(*(F.lit(n).cast("bigint") for n in range(tasks_per_key)))
        others = others.withColumn("_lookup_part", F.explode(parts))
        condition = condition & (F.col("_part") == F.col("_lookup_part"))
        drop += ["_part", "_lookup_part"]
    return facts.join(others, condition, how).drop(*drop)


def _all_equal(pairs: dict[str, str]) -> Column:
    condition = F.lit(True)
    for left, right in pairs.items():
        condition = condition & (F.col(left) == F.col(right))
    return condition


def spread_missing(key: Column, *by: str, numeric: bool = False) -> Column:
    """Join key of the preserved side of a left join.

    Missing keys match nothing but would all land in one partition; each gets a stand-in made from the
    ``by`` columns.  Pair it with a not-null test on ``key`` so that a stand-in can never match.
    """
    if numeric:
        return F.coalesce(key, F.xxhash64(*by))
    return F.coalesce(key.cast("string"), F.concat(F.lit("missing:"), F.xxhash64(*by).cast("string")))


def left_join_on_optional_key(
    facts: DataFrame,
    key: str,
    others: DataFrame,
    other_key: str,
    *,
    spread: list[str],
    also: dict[str, str] | None = None,
) -> DataFrame:
    """Left join where many facts may have no ``key``; the columns of ``others`` stay.

    Keys are compared as numbers when both are numbers, else as text.  ``also`` maps further columns that
    must be equal.  ``spread`` are fact columns that tell apart facts without a key.
    """
    numeric = dict(facts.dtypes)[key] == "bigint" == dict(others.dtypes)[other_key]
    kind = "bigint" if numeric else "string"
    right = others.filter(F.col(other_key).isNotNull()).withColumn("_other_key", F.col(other_key).cast(kind))
    left = facts.withColumn("_fact_key", spread_missing(F.col(key), *spread, numeric=numeric))
    condition = (F.col("_fact_key") == F.col("_other_key")) & F.col(key).isNotNull() & _all_equal(also or {})
    return left.join(right, condition, "left").drop("_fact_key", "_other_key")


def flag_join(
    facts: DataFrame, members: DataFrame, on: dict[str, str], key: str, flag: str, spread: list[str]
) -> DataFrame:
    """Add the boolean ``flag``: is there a row in ``members`` that equals the fact on all columns of ``on``?

    ``members`` is made distinct, so no fact is repeated.  ``key`` is the fact's member key, which may be
    missing; ``spread`` are fact columns that tell apart facts without a member.
    """
    names = {right: f"_flag_{right}" for right in on.values()}
    known = members.select(*on.values()).distinct().withColumnsRenamed(names).withColumn(flag, F.lit(True))
    also = {left: names[right] for left, right in on.items() if left != key}
    joined = left_join_on_optional_key(facts, key, known, names[on[key]], spread=spread, also=also)
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False))).drop(*names.values())
