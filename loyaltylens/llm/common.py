"""What the text operators share: input rows, tables in the shared folder, spans."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# Words are runs of anything but these characters.
SPACE_CLASS = r"\x20\x09-\x0D"
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# Private-use characters that mark matches inside a text; those of the text itself become SPARE first.
OPEN, CLOSE, SPARE = "\ue000", "\ue001", "\ue002"

SPAN_BLOCK = 128


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text only, whatever else ``docs`` holds; a missing text is empty."""
    return docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def ascii_lower(text: Column | str) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a temporary one only on one machine, where it is unset, as in
    tests."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder or "file://" + tempfile.mkdtemp(prefix="shared-")


def unused(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores in front as it takes to differ from every column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def one_of_each(df: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """The columns ``names`` of one row for each combination of ``keys``: of the row that is smallest in them.

    Rows are compared per task first.  Columns that have no order, such as maps, follow the others."""
    row = F.struct(*(F.col(f"`{n}`") for n in names))
    ordered = [F.col(f"`{n}`") for n in names if not _has_no_order(df.schema[n].dataType)]
    chosen = F.min(row) if len(ordered) == len(names) else F.min_by(row, F.struct(*ordered))
    found = unused(df, "row")
    return df.groupBy(*(f"`{k}`" for k in keys)).agg(chosen.alias(found)).select(f"{found}.*")


def _has_no_order(kind: DataType) -> bool:
    return any(word in kind.simpleString() for word in ("map<", "variant", "interval"))


def keep(df: DataFrame, **options: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again: later steps neither compute it a second
    time nor need the executors that made it.  ``options`` are those of the Parquet writer."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pieces(batches: Iterator[pa.RecordBatch], max_bytes: int = 1 << 20) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """Ids and UTF-8 texts of (doc_id, text) batches, cut so that the texts of a piece have about ``max_bytes``
    or are a single text."""
    for batch in batches:
        ids, column = batch.column(0), batch.column(1)
        lengths = pc.binary_length(column).to_pylist()
        start = total = 0
        for row, length in enumerate(lengths):
            if row > start and total + length > max_bytes:
                yield ids.slice(start, row - start), column.slice(start, row - start).cast(pa.binary()).to_pylist()
                start, total = row, 0
            total += length
        if lengths:
            yield ids.slice(start), column.slice(start).cast(pa.binary()).to_pylist()


def match_spans(text: Column, pattern: str, screen: str = "") -> Column:
    """Leftmost non-overlapping matches of a Java pattern as an array of (start, end, found), in code points.

    The matches are marked in one pass and the positions are added up over the parts between the marks.  The
    pattern must not match the private-use characters U+E000 to U+E002.  Only texts in which
    ``screen`` is found, by default the pattern, are marked up.
    """
    plain = F.translate(text, OPEN + CLOSE, SPARE * 2)
    marked = F.regexp_replace(plain, F.lit(f"({pattern})"), F.lit(f"{OPEN}$1{CLOSE}"))
    parts = F.split(marked, OPEN, -1)
    span_type = "struct<start:bigint,end:bigint,found:string>"
    none = F.array().cast(f"array<{span_type}>")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("spans"))

    def one(acc: Column, part: Column) -> Column:
        found = F.substring_index(part, CLOSE, 1)
        end = acc["at"] + F.length(found)
        span = F.struct(acc["at"].alias("start"), end.alias("end"), found.alias("found")).cast(span_type)
        after = (acc["at"] + F.length(part) - 1).cast("bigint")
        return F.struct(after.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    def block(n: Column) -> Column:
        return F.aggregate(F.slice(parts, n * SPAN_BLOCK + 2, F.lit(SPAN_BLOCK)), start, one)

    def add(acc: Column, own: Column) -> Column:
        moved = F.transform(
            own["spans"],
            lambda s: F.struct(
                (s["start"] + acc["at"]).alias("start"), (s["end"] + acc["at"]).alias("end"), s["found"].alias("found")
            ).cast(span_type),
        )
        at = (acc["at"] + own["at"]).cast("bigint")
        return F.struct(at.alias("at"), F.concat(acc["spans"], moved).alias("spans"))

    # Positions are added up within blocks of matches, then over the blocks, so that long lists are copied rarely.
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / SPAN_BLOCK).cast("int")), block)
    first = F.struct(F.length(parts[0]).cast("bigint").alias("at"), none.alias("spans"))
    spans = F.aggregate(blocks, first, add)["spans"]
    return F.when(text.rlike(screen or pattern), spans).otherwise(none)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def tagged(spans: Column, kind: str, rank: int) -> Column:
    """Spans with the name of their kind and its rank among the kinds."""
    return F.transform(
        spans,
        lambda s: F.struct(
            F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")
        ),
    )
