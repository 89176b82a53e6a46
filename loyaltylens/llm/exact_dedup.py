"""Exact duplicates by content-defined chunk recipes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyaltylens.llm.common import ascii_lower, keep, one_of_each, texts, unused

# A chunk ends at the first sentence or line end after MIN_CHUNK characters, or after MAX_CHUNK at the latest, so
# that texts that differ in one place have the same chunks again soon behind it.
MIN_CHUNK, MAX_CHUNK = 256, 2048
PARTS = 64  # tasks that the documents of one recipe are dealt to
CHUNK = rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK}}}?[.!?\n]|.{{1,{MAX_CHUNK}}}"


def chunks(text: Column) -> Column:
    """The text cut into chunks; an empty text has none."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def ambiguous_ids(normal: DataFrame) -> DataFrame:
    """Chunk identifiers that stand for more than one chunk.

    Every chunk is compared as a whole: equal chunks meet once per task before the shuffle and once after it.
    """
    each = normal.select(F.explode(chunks(F.col("normal"))).alias("chunk"))
    distinct = each.groupBy("chunk").agg(F.count(F.lit(1)).alias("uses"))
    return distinct.groupBy(F.xxhash64("chunk").alias("id")).count().filter("count > 1").select("id")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every document.

    Texts are equal when they are identical after lower-casing A-Z.  The text of a document becomes the ordered
    list of its chunk identifiers, which is all that is grouped and joined.  A group of any size is added up per
    task and in ``PARTS`` parts, and its documents meet the result of their own part.  Identifiers are verified: if two different chunks share one, the documents that use it are told
    apart by the hash of their text as well.

    A missing text counts as empty.  Rows that repeat an id and a text come back as often as they are there, all
    of them kept if their id is.  A very long text is a long list, never compared as a text but by its chunks.
    Columns other than id and text are not looked at.  Documents without an id are kept only where no equal text has an id.
    """
    normal = texts(docs, id_col, text_col).select("doc_id", ascii_lower("text").alias("normal"))
    recipes = normal.select(
        "doc_id",
        F.transform(chunks(F.col("normal")), lambda c: F.xxhash64(c)).alias("recipe"),
        F.sha2(F.col("normal").cast("binary"), 256).alias("text_sha256"),
    )
    recipes = keep(recipes)
    shared = keep(ambiguous_ids(normal))
    if shared.isEmpty():
        keyed = recipes.withColumn("told_apart", F.lit(""))
    else:
        unsure = recipes.select("recipe").distinct().withColumn("id", F.explode(F.array_distinct("recipe")))
        unsure = unsure.join(shared, "id").select("recipe").distinct().withColumn("unsure", F.lit(True))
        told_apart = F.when(F.col("unsure"), F.col("text_sha256")).otherwise("")
        keyed = recipes.join(unsure, "recipe", "left").withColumn("told_apart", told_apart).drop("unsure")
    keyed = keyed.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
    same = ["recipe", "told_apart"]
    parts = keyed.groupBy(*same, "part").agg(F.max("doc_id").alias("largest"), F.count(F.lit(1)).alias("rows"))
    totals = parts.groupBy(*same).agg(F.max("largest").alias("keep_id"), F.sum("rows").alias("group_size"))
    groups = parts.select(*same, "part").join(totals, same)
    return keyed.join(groups, [*same, "part"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


ORACLE = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g ON d.text_sha256 = g.text_sha256
"""


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that :func:`exact_dedup` keeps, one row each, with all their columns.

    Of documents without an id whose texts are equal, one stays if no document with an id has the text.  Of rows
    with the same id and text, the one stays that is smallest in its columns, in their order.
    """
    found = exact_dedup(docs, id_col, text_col).filter("kept")
    kept = found.select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_hash"))
    own_hash = F.sha2(ascii_lower(F.coalesce(docs[text_col], F.lit(""))).cast("binary"), 256)
    name = unused(docs, "hash")
    hashed = docs.withColumn(name, own_hash)
    same = hashed[id_col].eqNullSafe(kept["kept_id"]) & (hashed[name] == kept["kept_hash"])
    return one_of_each(hashed.join(kept, same, "left_semi"), [id_col, name], docs.columns)
