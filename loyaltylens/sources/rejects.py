"""Source rows that do not fit the canonical types: told apart row by row, with the reasons, instead of stopping the job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def checked(df: DataFrame, schema: str) -> DataFrame:
    """Every row once: ``fits`` (the columns of ``schema``, cast), ``raw`` (the row as JSON) and ``problems``.

    A problem is a value that is there and that its type cannot hold: its column, the type and the value as text.
    Missing values are no problem.  One pass, no shuffle.
    """
    target = StructType.fromDDL(schema)
    cast = {f.name: F.col(f.name).try_cast(f.dataType) for f in target.fields}
    found = [
        F.when(
            F.col(f.name).isNotNull() & cast[f.name].isNull(),
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("expected"),
                F.col(f.name).cast("string").alias("value"),
            ),
        )
        for f in target.fields
    ]
    return df.select(
        F.struct(*(c.alias(name) for name, c in cast.items())).alias("fits"),
        F.to_json(F.struct(*df.columns)).alias("raw"),
        F.array_compact(F.array(*found)).alias("problems"),
    )


def accepted(rows: DataFrame) -> DataFrame:
    """The rows without a problem, in the columns and types of the schema."""
    return rows.filter(F.size("problems") == 0).select("fits.*")


def rejected(rows: DataFrame) -> DataFrame:
    """``raw`` and ``problems`` of the other rows, to be written to a reject table."""
    return rows.filter(F.size("problems") > 0).select("raw", "problems")


def reasons(rejects: DataFrame) -> DataFrame:
    """Rejected values per column and type: ``column_name``, ``expected``, ``row_count`` and the smallest such value."""
    each = rejects.select(F.inline("problems"))
    return each.groupBy("column_name", "expected").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("value").alias("example")
    )
