"""Members located in a city by location segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyaltylens.functions import fixed
from loyaltylens.operators.joins import lookup_join
from loyaltylens.operators.latest import latest_batch, newest_values


def newest_segment_rows(log: DataFrame, segment_map: DataFrame) -> DataFrame:
    """Log rows of each segment's newest batch that are in the segment, with the segment's cities.

    The newest batch is taken over all rows; the in-segment flag is looked at afterwards.
    """
    newest = latest_batch(log, "prop_key", "update_time", segment_map)
    return _with_cities(newest.filter(F.col("prop_value") == fixed.IN_SEGMENT), segment_map)


def _with_cities(rows: DataFrame, segment_map: DataFrame) -> DataFrame:
    mapping = segment_map.select(F.col("prop_key").alias("_segment"), "city_cn")
    return lookup_join(rows, mapping, {"prop_key": "_segment"}, how="inner")


def newest_log(log: DataFrame, segment_map: DataFrame, id_prop: str = fixed.CRM_ID_PROPERTY) -> DataFrame:
    """Newest row per user of every segment and of the member id, from one read of the log."""
    id_row = log.sparkSession.range(1).select(F.lit(id_prop).alias("prop_key"))
    wanted = segment_map.select("prop_key").unionByName(id_row).distinct()
    rows = lookup_join(log, wanted, {"prop_key": "prop_key"}, how="left_semi")
    in_segment = (F.col("prop_key") != id_prop) & (F.col("prop_value") == fixed.IN_SEGMENT)
    return newest_values(rows, in_segment)


def _last_batch(rows: DataFrame, log: DataFrame, segment_map: DataFrame) -> DataFrame:
    """Rows of the newest batch of their segment.  The batches take a scan of two columns, added up per task: one
    segment may hold most of the log, so it is not ranked in one task."""
    wanted = segment_map.select("prop_key").distinct()
    batches = lookup_join(log, wanted, {"prop_key": "prop_key"}, how="left_semi").groupBy(F.col("prop_key").alias("_key")).agg(F.max("update_time").alias("_time"))
    return lookup_join(rows, batches, {"prop_key": "_key", "update_time": "_time"}, how="left_semi")


def _one_city(rows: DataFrame, log: DataFrame, segment_map: DataFrame, *also: str) -> DataFrame:
    """The smallest city name per segment and user.  Whoever is in the newest batch has his newest row there."""
    placed = _with_cities(_last_batch(rows, log, segment_map), segment_map)
    return placed.groupBy("prop_key", "gio_id", *also).agg(F.min("city_cn").alias("city_cn"))


def segment_users(log: DataFrame, segment_map: DataFrame) -> DataFrame:
    """One city per segment and user of the segment's newest batch who is in the segment."""
    in_segment = newest_log(log, segment_map).filter(F.col("prop_value") == fixed.IN_SEGMENT)
    return _one_city(in_segment, log, segment_map).select("prop_key", "city_cn", "gio_id")


def latest_attribute(log: DataFrame, prop_key: str) -> DataFrame:
    """Newest value of one attribute per user; of several at that time, the smallest."""
    rows = log.filter(F.col("prop_key") == prop_key)
    return newest_values(rows, F.lit(False)).select("gio_id", "prop_value")


def segment_members(log: DataFrame, segment_map: DataFrame, id_prop: str = fixed.CRM_ID_PROPERTY) -> DataFrame:
    """Segment, city and member id of located users whose member id is known."""
    return members_of_newest(newest_log(log, segment_map, id_prop), log, segment_map, id_prop)


def members_of_newest(newest: DataFrame, batches: DataFrame, segment_map: DataFrame, id_prop: str) -> DataFrame:
    """Located members from the newest rows per property and user; ``batches`` holds the newest time of each segment.

    A user's newest rows, no more than there are segments, come together once and carry the member id along.
    """
    own = F.collect_list(F.struct("prop_key", "update_time", "prop_value")).alias("own")
    member_id = F.filter("own", lambda p: p["prop_key"] == id_prop)
    segments = F.filter("own", lambda p: p["prop_value"] == fixed.IN_SEGMENT)
    users = newest.groupBy("gio_id").agg(own).filter(F.size(member_id) > 0)
    rows = users.select("gio_id", member_id[0]["prop_value"].alias("crm_member_id"), F.inline(segments))
    placed = _one_city(rows, batches, segment_map, "crm_member_id")
    return placed.select("prop_key", "city_cn", "crm_member_id").distinct()
