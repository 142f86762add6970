"""Table writes, row counts taken during the write, and staged intermediates."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_FORMAT = "parquet"
#: Formats whose tables are plain folders; others replace a table in one transaction.
FOLDER_FORMATS = ("parquet", "orc", "json", "csv", "avro")


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    format: str = DEFAULT_FORMAT,
    path: str | None = None,
) -> int:
    """Write a catalog table and return the number of rows written.

    The count is observed in the writing tasks, so the table is not read again and a
    recomputed shuffle is not counted twice. Rows of a partitioned table are first
    brought together by partition, or every task would add a file to every partition;
    a partition that holds too many rows is split over several tasks.

    An overwrite writes a new version beside the old one and then points the table to
    it, so a write that fails leaves the table as it was. ``path`` is the folder of the
    versions; the one before the last is kept for readers that still have it open.
    """
    if mode == "overwrite" and format in FOLDER_FORMATS:
        version = write_version(df, name, partition_by, format, path)
        version.publish()
        return version.rows
    writer, written = _counted(df, partition_by, format)
    writer = writer.mode(mode)
    if mode == "overwrite":
        writer = writer.option("overwriteSchema", "true")
    if path and not df.sparkSession.catalog.tableExists(name):
        versioned = format in FOLDER_FORMATS
        writer = writer.option("path", _version(path) if versioned else path)
    writer.saveAsTable(name)
    return written.get["rows"]


def _counted(df: DataFrame, partition_by: Sequence[str], format: str):
    """A writer of the frame that counts its rows, and where the count will be."""
    written = Observation()
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.format(format)
    return (writer.partitionBy(*partition_by) if partition_by else writer), written


def _version(folder: str) -> str:
    return f"{folder.rstrip('/')}/version-{uuid.uuid4().hex}"


def write_version(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    format: str = DEFAULT_FORMAT,
    path: str | None = None,
) -> Version:
    """Write the next version of a table; nobody reads it before it is published."""
    spark = df.sparkSession
    folder = path or f"{warehouse(spark)}/{name.replace('.', '/')}-versions"
    place = _version(folder)
    writer, written = _counted(df, partition_by, format)
    # An unknown database or a wrong name is found before anything is written.
    spark.catalog.tableExists(name)
    writer.mode("errorifexists").save(place)
    return Version(
        spark, name, folder, place, df.schema, tuple(partition_by), format, written.get["rows"]
    )


@dataclass
class Version:
    """A written version of a table. ``publish`` points the table to it.

    Where the columns are the same, or some were added at the end, the table stays and
    only its location changes, in one step of the catalog: there is always a table to
    read, and its comment and properties remain. Other changes of columns or partitioning
    make the table anew with its comment and properties.
    """

    spark: SparkSession
    name: str
    folder: str
    place: str
    schema: T.StructType
    partition_by: tuple[str, ...]
    format: str
    rows: int
    _before: str | None = None
    _replaced: tuple[str, str, list[str], str, str] | None = None

    @property
    def _table(self) -> str:
        return ".".join(map(_quoted, self.name.split(".")))

    def publish(self) -> None:
        spark, table = self.spark, self._table
        exists = spark.catalog.tableExists(self.name)
        self._before = _described(spark, table).get("Location") if exists else None
        self._replaced = None
        added = self._added_columns() if exists else None
        if added is None:
            clauses = _comment(spark, table) if exists else ""
            self._replaced = _definition(spark, self.name, clauses) if exists else None
            self._make(
                _columns(self.schema.fields), self.format, self.partition_by, self.place, clauses
            )
        else:
            if added:
                spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_columns(added)})")
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{self.place}'")
        spark.catalog.refreshTable(self.name)
        keep = {_last(p) for p in (self.place, self._before) if p}
        for other in folders(spark, self.folder):
            if _last(other).startswith("version-") and _last(other) not in keep:
                delete_folder(spark, other)

    def withdraw(self) -> None:
        """Give the table its version before again, if it has this one; delete this one."""
        spark, table = self.spark, self._table
        if spark.catalog.tableExists(self.name):
            now = _described(spark, table).get("Location")
            if now and _last(now) == _last(self.place):
                if self._replaced:
                    self._make(*self._replaced)
                elif self._before:
                    spark.sql(f"ALTER TABLE {table} SET LOCATION '{self._before}'")
                else:
                    spark.sql(f"DROP TABLE {table}")
                if self._before:
                    spark.catalog.refreshTable(self.name)
        delete_folder(spark, self.place)

    def _added_columns(self) -> list[T.StructField] | None:
        """Columns to add at the end; None where the table has to be made anew."""
        described = _described(self.spark, self._table)
        old = self.spark.table(self.name).schema.fields
        parts = [c.name for c in self.spark.catalog.listColumns(self.name) if c.isPartition]
        tracked = "Partition Provider" in described
        if described.get("Provider", "").lower() != self.format.lower() or tracked:
            return None
        # Partition columns come last in the catalog.
        new = [f for f in self.schema.fields if f.name not in self.partition_by]
        held = [f for f in old if f.name not in parts]
        if parts != list(self.partition_by) or len(new) < len(held):
            return None

        def same(a: T.StructField, b: T.StructField) -> bool:
            return a.name == b.name and a.dataType == b.dataType

        alike = all(same(a, b) for a, b in zip(held, new))
        alike &= all(self.schema[f.name].dataType == f.dataType for f in old if f.name in parts)
        return new[len(held) :] if alike else None

    def _make(
        self, columns: str, format: str, parts: Sequence[str], place: str, clauses: str
    ) -> None:
        spark, table = self.spark, self._table
        by = f"PARTITIONED BY ({', '.join(map(_quoted, parts))}) " if parts else ""
        tracked = "spark.sql.hive.manageFilesourcePartitions"
        setting = spark.conf.get(tracked)
        # Partitions are found in the folders, so that a new location brings its own.
        spark.conf.set(tracked, "false")
        try:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
            spark.sql(
                f"CREATE TABLE {table} ({columns}) USING {format} {by}LOCATION '{place}'{clauses}"
            )
        finally:
            spark.conf.set(tracked, setting)


def publish_together(versions: Sequence[Version]) -> None:
    """Publish all versions, or none: a failure withdraws those that were published."""
    done: list[Version] = []
    try:
        for version in versions:
            done.append(version)
            version.publish()
    except Exception:
        for version in reversed(done):
            version.withdraw()
        raise


def replace_run(
    df: DataFrame,
    name: str,
    run_id: str,
    format: str = DEFAULT_FORMAT,
    path: str | None = None,
) -> int:
    """Write the rows of one run to a log; what the run wrote there before is replaced.

    The log is partitioned by ``run_id`` and other runs' rows are not touched, so a run
    that is repeated leaves its rows once. The partition of the run is written as a whole,
    with no file of rows if there are none.
    """
    spark = df.sparkSession
    if format not in FOLDER_FORMATS:
        writer, written = _counted(df, (), format)
        mine = "run_id = '" + run_id.replace("'", "\\'") + "'"
        exists = spark.catalog.tableExists(name)
        writer = writer.mode("overwrite" if exists else "append")
        (writer.option("replaceWhere", mine) if exists else writer).saveAsTable(name)
        return written.get["rows"]
    if not spark.catalog.tableExists(name):
        write_version(df.limit(0), name, ["run_id"], format, path).publish()
    table = ".".join(map(_quoted, name.split(".")))
    folder = _described(spark, table)["Location"]
    escaped = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    part = escaped.getPartitionPathString("run_id", run_id)
    writer, written = _counted(df.drop("run_id"), (), format)
    writer.mode("overwrite").save(f"{folder.rstrip('/')}/{part}")
    spark.catalog.refreshTable(name)
    return written.get["rows"]


def _columns(fields: Sequence[T.StructField]) -> str:
    return ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in fields)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


_SET_BY_SPARK = (
    "transient_lastDdlTime", "comment", "EXTERNAL", "external", "owner", "location", "provider",
)


def _comment(spark: SparkSession, table: str) -> str:
    """Clauses that give a new table the comment and properties of the old one."""
    comment = _described(spark, table).get("Comment")
    listed = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    own = [(r["key"], r["value"]) for r in listed if not r["key"].startswith("spark.sql.")]
    own = [(k, v) for k, v in own if k not in _SET_BY_SPARK]
    pairs = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in own)
    return (f" COMMENT {_text(comment)}" if comment else "") + (
        f" TBLPROPERTIES ({pairs})" if pairs else ""
    )


def _definition(
    spark: SparkSession, name: str, clauses: str
) -> tuple[str, str, list[str], str, str]:
    """Columns, format, partition columns, place and clauses of a table as it is."""
    described = _described(spark, ".".join(map(_quoted, name.split("."))))
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    columns = _columns(spark.table(name).schema.fields)
    return columns, described["Provider"], parts, described["Location"], clauses


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _last(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def _described(spark: SparkSession, quoted: str) -> dict[str, str]:
    """What the catalog says of a table itself, without its columns."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted}").collect()
    names = [r["col_name"] for r in rows]
    at = names.index("# Detailed Table Information")
    return {r["col_name"]: r["data_type"] for r in rows[at + 1 :]}


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def folders(spark: SparkSession, path: str) -> list[str]:
    """Folders directly under a path; none where the path is missing."""
    system, target = _file_system(spark, path)
    if not system.exists(target):
        return []
    return [
        s.getPath().toString() for s in system.listStatus(target) if s.isDirectory()
    ]


def delete_folder(spark: SparkSession, path: str) -> None:
    system, target = _file_system(spark, path)
    system.delete(target, True)


def count_rows(spark: SparkSession, name: str) -> int:
    """Rows of a finished table."""
    return spark.table(name).count()


def warehouse(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors can reach, as the session names it.

    A session that names none has its warehouse, which is shared as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir() or f"{warehouse(spark)}/_stages"
    return folder.rstrip("/")


_OWNER: ContextVar[str | None] = ContextVar("stage_owner", default=None)


@contextmanager
def owned_stages(spark: SparkSession) -> Iterator[str]:
    """Stages made inside belong to the caller and are deleted at the end.

    Nothing that is read after the end may be built on them.
    """
    folder = f"{shared_folder(spark)}/job-{uuid.uuid4().hex}"
    token = _OWNER.set(folder)
    try:
        yield folder
    finally:
        _OWNER.reset(token)
        delete_folder(spark, folder)


def new_folder(spark: SparkSession, label: str) -> str:
    """Unused path under the shared folder; nothing is created yet."""
    return f"{_OWNER.get() or shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame once and read it back, so later reads do not recompute it.

    Reads of the result prune columns, and a lost executor costs no recomputation.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
