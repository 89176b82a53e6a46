"""Reading canonical tables and writing report tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loyaltylens.functions.exprs import batch_day
from loyaltylens.sources.contract import fitted
from loyaltylens.sources.rejects import accepted, checked, rejected
from loyaltylens.sources.schemas import LOCATED_SCHEMA, SCHEMAS


def conform(df: DataFrame, schema: str) -> DataFrame:
    """Keep the columns of ``schema`` in order and cast them to its types."""
    target = StructType.fromDDL(schema)
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields))


class Tables(Mapping[str, DataFrame]):
    """Canonical tables by name; each one is read only when a report asks for it.

    ``location`` maps a canonical name to a catalog table or, with ``root``, to a Parquet folder below
    it.  ``columns`` renames source columns: ``{"member": {"detail_id": "member_detail_id"}}``.
    """

    def __init__(
        self,
        spark: SparkSession,
        *,
        root: str | None = None,
        location: Mapping[str, str] | None = None,
        columns: Mapping[str, Mapping[str, str]] | None = None,
        skip_misfits: bool = False,
    ) -> None:
        self._spark = spark
        self._skip_misfits = skip_misfits
        self._root = root
        self._location = dict(location or {})
        self._columns = {name: dict(renames) for name, renames in (columns or {}).items()}
        self._schemas = {**SCHEMAS, "located": LOCATED_SCHEMA}

    def _raw(self, name: str) -> DataFrame:
        if name not in self._schemas:
            raise KeyError(name)
        place = self._location.get(name, name)
        raw = self._spark.table(place) if self._root is None else self._spark.read.parquet(f"{self._root}/{place}")
        return raw.withColumnsRenamed(self._columns.get(name, {}))

    def __getitem__(self, name: str) -> DataFrame:
        if self._skip_misfits:
            return accepted(checked(self._raw(name), self._schemas[name]))
        return conform(self._raw(name), self._schemas[name])

    def rejects(self, name: str) -> DataFrame:
        """The rows that ``skip_misfits`` leaves out, with the reasons."""
        return rejected(checked(self._raw(name), self._schemas[name]))

    def __iter__(self) -> Iterator[str]:
        return iter(self._schemas)

    def __len__(self) -> int:
        return len(self._schemas)


def with_audit_columns(df: DataFrame, as_of: date) -> DataFrame:
    """Batch day and load time."""
    return df.withColumns({"dl_batch_date": batch_day(as_of), "dl_load_time": F.current_timestamp()})


def refresh(
    df: DataFrame,
    target: str,
    *,
    as_table: bool = False,
    as_of: date | None = None,
    label: str = "",
    keep: int = 2,
    new_columns: bool = False,
) -> None:
    """Replace the whole content of ``target``, a folder or a name in the catalog, in one step.

    Every refresh writes a numbered version of its own; then one step makes it the current one: an empty file whose name
    is that of the version, or the view that carries the name of the table.  Whatever stops the job, and between whichever
    steps, readers find a whole version: the old one before that step, the new one after it.  The last
    ``keep`` versions stay, for readers that are still at an older one; the others are dropped at the end.  A report may
    read what it replaces.

    Columns are matched by name with those of the current version, whose order and types stay; columns that are
    missing, too many or do not fit are an error before anything is written, unless ``new_columns`` asks
    for another shape.  ``label`` is kept with the version (:func:`current_label`).  Read folders with :func:`current`.
    """
    out = with_audit_columns(df, as_of) if as_of is not None else df
    if "." in label:
        raise ValueError("a label must not hold a dot")
    versions = _TableVersions(df.sparkSession, target) if as_table else _FolderVersions(df.sparkSession, target)
    now = versions.current()
    if now is not None and not new_columns:
        out = fitted(out, versions.read(now).schema, target)
    name = f"{versions.last_number() + 1:08d}.{label}.{uuid.uuid4().hex[:12]}"
    versions.write(out, name)
    versions.switch(name)
    versions.drop_before(max(0, _number(name) - keep + 1))


def current(spark: SparkSession, target: str) -> DataFrame:
    """The content of a folder that :func:`refresh` writes; of a plain Parquet folder its files."""
    versions = _FolderVersions(spark, target)
    return versions.read(versions.current() or "")


def current_label(spark: SparkSession, target: str) -> str | None:
    """The label of the current version of a folder, NULL where there is none yet."""
    name = _FolderVersions(spark, target).current()
    return name.split(".")[1] if name else None


def _number(name: str) -> int:
    return int(name.split(".")[0])


class _FolderVersions:
    """Versions as folders below the target, and empty files in ``_versions`` that name those which are whole.

    The file with the highest number names the current version.  It is made in one step on any file system, and no file is
    ever replaced.
    """

    def __init__(self, spark: SparkSession, target: str) -> None:
        self._spark, self._target = spark, target.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self._target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return [f.getPath().getName() for f in self._files.listStatus(path)] if self._files.exists(path) else []

    def _whole(self) -> list[str]:
        return sorted(n for n in self._names(f"{self._target}/_versions") if n[:8].isdigit())

    def current(self) -> str | None:
        return max(self._whole(), default=None) or ("" if self._plain_files() else None)

    def _plain_files(self) -> list[str]:
        return [n for n in self._names(self._target) if n.startswith("part-")]

    def last_number(self) -> int:
        begun = [n for n in self._names(self._target) if n[:8].isdigit()]
        return max((_number(n) for n in [*begun, *self._whole()]), default=0)

    def read(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._target}/{name}" if name else self._target)

    def write(self, df: DataFrame, name: str) -> None:
        df.write.parquet(f"{self._target}/{name}")

    def switch(self, name: str) -> None:
        self._files.mkdirs(self._path(f"{self._target}/_versions"))
        self._files.create(self._path(f"{self._target}/_versions/{name}"), False).close()

    def drop_before(self, number: int) -> None:
        for name in self._whole():
            if _number(name) < number:
                self._files.delete(self._path(f"{self._target}/_versions/{name}"), False)
        old = [n for n in self._names(self._target) if n[:8].isdigit() and _number(n) < number]
        for name in [*old, *(self._plain_files() if number > 1 else [])]:
            self._files.delete(self._path(f"{self._target}/{name}"), True)


class _TableVersions:
    """Versions as catalog tables ``<name>__v<number>...``, and a view of the table's name over the current one.

    Replacing the view is one step of the catalog.  A plain table of that name becomes the first version.
    """

    def __init__(self, spark: SparkSession, target: str) -> None:
        self._spark, self._target = spark, target
        self._schema, _, self._name = target.rpartition(".")
        if self._exists(target) and not self._is_view():
            spark.sql(f"ALTER TABLE {target} RENAME TO {self._table('00000000..')}")
            self.switch("00000000..")

    def _exists(self, name: str) -> bool:
        return self._spark.catalog.tableExists(name)

    def _is_view(self) -> bool:
        return self._spark.catalog.getTable(self._target).tableType == "VIEW"

    def _table(self, name: str) -> str:
        own = f"{self._name}__v{name.replace('.', '__')}"
        return f"{self._schema}.`{own}`" if self._schema else f"`{own}`"

    def _numbers(self) -> dict[str, int]:
        prefix = f"{self._name}__v".lower()
        tables = self._spark.catalog.listTables(self._schema or None)
        return {t.name: int(t.name[len(prefix) :][:8]) for t in tables if t.name.lower().startswith(prefix)}

    def current(self) -> str | None:
        return "" if self._exists(self._target) else None

    def last_number(self) -> int:
        return max(self._numbers().values(), default=0)

    def read(self, name: str) -> DataFrame:
        return self._spark.table(self._target)

    def write(self, df: DataFrame, name: str) -> None:
        df.write.format("parquet").saveAsTable(self._table(name))

    def switch(self, name: str) -> None:
        self._spark.sql(f"CREATE OR REPLACE VIEW {self._target} AS SELECT * FROM {self._table(name)}")

    def drop_before(self, number: int) -> None:
        for table, own in self._numbers().items():
            if own < number:
                self._spark.sql(f"DROP TABLE IF EXISTS {self._schema + '.' if self._schema else ''}`{table}`")


@contextmanager
def saved(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` written to the shared folder that ``spark.checkpoint.dir`` names, for as long as it is needed.

    Without such a folder ``df`` is returned as it is, and every reader computes it.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not shared:
        yield df
        return
    folder = f"{shared}/saved_{uuid.uuid4().hex}"
    try:
        df.write.parquet(folder)
        yield spark.read.schema(df.schema).parquet(folder)
    finally:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
