"""City bands and labels."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyaltylens.functions import fixed
from loyaltylens.operators.joins import lookup_join


@dataclass(frozen=True)
class CityBands:
    """Maturity bands of the cities that have a store, in the forms that joins need."""

    by_city: DataFrame  # city_cn, city_maturity_type
    by_store: DataFrame  # store_code, city_maturity_type
    typed_cities: DataFrame  # city_cn of cities with a band
    typed_stores: DataFrame  # store_code of stores in such cities


def city_maturity(stores: DataFrame, city_type: DataFrame) -> DataFrame:
    """Maturity band of every city that has a store; NULL for a city without a band."""
    return _banded(stores.select("city_cn").distinct(), city_type).distinct()


def _banded(places: DataFrame, city_type: DataFrame) -> DataFrame:
    bands = city_type.select("city_chn", F.col("city_type").alias("city_maturity_type"))
    return places.join(bands, places.city_cn == bands.city_chn, "left").drop("city_chn")


def city_bands(stores: DataFrame, city_type: DataFrame) -> CityBands:
    places = stores.select("store_code", "city_cn")
    typed = city_type.filter(F.col("city_type").isNotNull())
    in_typed = places.join(typed, places.city_cn == typed.city_chn, "left_semi")
    return CityBands(
        by_city=city_maturity(stores, city_type),
        by_store=_banded(places, city_type).select("store_code", "city_maturity_type"),
        typed_cities=in_typed.select("city_cn").distinct(),
        typed_stores=in_typed.select("store_code").distinct(),
    )


def city_tiers(city_tier: DataFrame) -> DataFrame:
    """city_cn, city_tier"""
    return city_tier.select(F.col("city_chn").alias("city_cn"), "city_tier").distinct()


def label_sets(lookup: DataFrame, key: str, label: str, missing: str) -> DataFrame:
    """One row per key with all its labels, so that joining it never repeats a fact."""
    named = lookup.filter(F.col(key).isNotNull()).select(key, F.coalesce(F.col(label), F.lit(missing)).alias("_label"))
    return named.groupBy(key).agg(F.collect_set("_label").alias("_labels"))


def with_labels(
    facts: DataFrame,
    lookup: DataFrame,
    *,
    fact_key: str,
    lookup_key: str,
    lookup_label: str,
    label: str,
    missing_label: str,
    missing_key_label: str | None = None,
    total: str | None = None,
) -> DataFrame:
    """Repeat each fact once per label of its key, and once more under ``total``.

    A key without a label gets ``missing_label`` and a missing key ``missing_key_label`` (the same by
    default).  A key with several labels counts under each of them but once in the total.
    """
    sets = label_sets(lookup, lookup_key, lookup_label, missing_label)
    joined = lookup_join(facts, sets, {fact_key: lookup_key})
    found = F.coalesce(F.col("_labels"), F.array(F.lit(missing_label)))
    if missing_key_label is not None:
        found = F.when(F.col(fact_key).isNull(), F.array(F.lit(missing_key_label))).otherwise(found)
    if total is not None:
        found = F.concat(found, F.array(F.lit(total)))
    return joined.withColumn(label, F.explode(found)).drop("_labels")


def maturity_labelled(
    facts: DataFrame, bands: CityBands, *, city: str, missing_city: str | None = None, total: bool = True
) -> DataFrame:
    return with_labels(
        facts,
        bands.by_city,
        fact_key=city,
        lookup_key="city_cn",
        lookup_label="city_maturity_type",
        label="city_maturity_type",
        missing_label=fixed.UNSPECIFIED_BAND,
        missing_key_label=missing_city,
        total=fixed.TOTAL if total else None,
    )


def tier_labelled(facts: DataFrame, tiers: DataFrame, *, city: str, total: bool = True) -> DataFrame:
    return with_labels(
        facts,
        tiers,
        fact_key=city,
        lookup_key="city_cn",
        lookup_label="city_tier",
        label="city_tier",
        missing_label=fixed.OTHERS,
        total=fixed.TOTAL if total else None,
    )


def grain_labelled(
    facts: DataFrame, bands: CityBands, tiers: DataFrame, *, city: str, missing_city: str | None = None
) -> DataFrame:
    """Repeat each fact once per grain and segment of its city, in the struct ``segment``: (grain, name).

    Grains are ``city``, ``maturity``, ``tier`` and ``total``; the labels are those of :func:`maturity_labelled` and
    :func:`tier_labelled`.
    """

    def named(grain: str, names: Column) -> Column:
        return F.transform(names, lambda n: F.struct(F.lit(grain).alias("grain"), n.alias("name")))

    band_sets = label_sets(bands.by_city, "city_cn", "city_maturity_type", fixed.UNSPECIFIED_BAND)
    tier_sets = label_sets(tiers, "city_cn", "city_tier", fixed.OTHERS).withColumnRenamed("_labels", "_tiers")
    joined = lookup_join(lookup_join(facts, band_sets, {city: "city_cn"}), tier_sets, {city: "city_cn"})
    band = F.coalesce(F.col("_labels"), F.array(F.lit(fixed.UNSPECIFIED_BAND)))
    if missing_city is not None:
        band = F.when(F.col(city).isNull(), F.array(F.lit(missing_city))).otherwise(band)
    segments = F.concat(
        named("city", F.array(F.col(city))),
        named("maturity", band),
        named("tier", F.coalesce(F.col("_tiers"), F.array(F.lit(fixed.OTHERS)))),
        named("total", F.array(F.lit(fixed.TOTAL))),
    )
    return joined.withColumn("segment", F.explode(segments)).drop("_labels", "_tiers")
