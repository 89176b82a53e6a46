"""What a table expects of the rows that are written to it: columns by name, types that fit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
    StructType,
    TimestampNTZType,
)

# Whole numbers by width, and the digits each may have.
WHOLE = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}


class ContractError(ValueError):
    """Rows that do not fit the table they are meant for; nothing was written."""

    def __init__(self, target: str, problems: list[str]) -> None:
        super().__init__(f"{target}: {'; '.join(problems)}")
        self.problems = problems


def keeps_values(given: DataType, kept: DataType) -> bool:
    """Does every value of type ``given`` fit type ``kept`` unchanged?"""
    if given == kept or isinstance(given, NullType):
        return True
    from_whole, to_whole = WHOLE.get(type(given)), WHOLE.get(type(kept))
    if isinstance(given, DecimalType) and isinstance(kept, DecimalType):
        return given.scale <= kept.scale and given.precision - given.scale <= kept.precision - kept.scale
    if from_whole and to_whole:
        return from_whole <= to_whole
    if from_whole and isinstance(kept, DecimalType):
        return from_whole <= kept.precision - kept.scale
    if from_whole and isinstance(kept, (FloatType, DoubleType)):
        return from_whole <= (7 if isinstance(kept, FloatType) else 10)
    pairs = ((FloatType, DoubleType), (DateType, TimestampNTZType))
    return any(isinstance(given, a) and isinstance(kept, b) for a, b in pairs)


def problems(given: StructType, kept: StructType) -> list[str]:
    """Columns that are missing, too many, named twice, or whose values may not fit; upper and lower case are one."""
    found = []
    names = [f.name.lower() for f in given.fields]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        found.append(f"columns named twice: {', '.join(twice)}")
    mine = {f.name.lower(): f for f in given.fields}
    theirs = {f.name.lower(): f for f in kept.fields}
    if lost := [f.name for n, f in theirs.items() if n not in mine]:
        found.append(f"missing columns: {', '.join(lost)}")
    if extra := [f.name for n, f in mine.items() if n not in theirs]:
        found.append(f"columns too many: {', '.join(extra)}")
    for n, f in theirs.items():
        if n in mine and not keeps_values(mine[n].dataType, f.dataType):
            found.append(f"{f.name}: {mine[n].dataType.simpleString()} does not fit {f.dataType.simpleString()}")
    return found


def fitted(df: DataFrame, kept: StructType, target: str) -> DataFrame:
    """``df`` with the columns of ``kept``, by name, in its order and types; raises before anything is written."""
    if found := problems(df.schema, kept):
        raise ContractError(target, found)
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in kept.fields))


def insert_by_name(df: DataFrame, table: str, *, overwrite: bool = False) -> None:
    """Add rows to a catalog table, or replace its rows, matching columns by name whatever their order."""
    spark = df.sparkSession
    fitted(df, spark.table(table).schema, table).write.insertInto(table, overwrite=overwrite)
