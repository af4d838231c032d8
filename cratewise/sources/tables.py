"""Parquet tables: finished ones, replaced as a whole and together, and keyed ones.

``Tables`` writes new copies beside the old ones (``<root>/<table>/run=<n>``) and then one
marker (``<root>/_committed/<n>``). Readers take the newest copy that has a marker, so a
run that dies half-way leaves every table as it was. ``KeyedTables`` overwrites the
partitions that a batch touches. One writer at a time is assumed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cratewise.session import stored
from cratewise.sources.folders import Folder


def empty(spark: SparkSession, schema: str | StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def conform(df: DataFrame, schema: str) -> DataFrame:
    """The columns of ``schema`` in its order; columns ``df`` lacks come as typed NULLs."""
    fields = empty(df.sparkSession, schema).schema.fields
    have = set(df.columns)

    def column(field) -> Column:
        source = F.col(field.name) if field.name in have else F.lit(None)
        return source.cast(field.dataType).alias(field.name)

    return df.select(*[column(field) for field in fields])


def fill_counter(df: DataFrame, column: str) -> DataFrame:
    """Counters that were added later start at 0."""
    return df.na.fill(0, [column])


class Tables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def read(self, table: str, schema: str | StructType) -> DataFrame:
        """Current rows; an empty table while none was stored."""
        run = self._newest(table)
        if run is None:
            return empty(self.spark, schema)
        # Columns the stored files lack read as NULL.
        return self.spark.read.schema(schema).parquet(f"{self.root}/{table}/run={run}")

    def replace(self, **tables: DataFrame) -> None:
        """Store new versions of the given tables; all become current together."""
        run = self._next_run(tables)
        for name, df in tables.items():
            df.write.parquet(f"{self.root}/{name}/run={run}")
        self._commit(run)

    def clear(self, table: str, schema: str) -> bool:
        """Empty a table; False when there is none."""
        if self._newest(table) is None:
            return False
        self.replace(**{table: empty(self.spark, schema)})
        return True

    def _next_run(self, tables) -> int:
        return 1 + max(
            [0, *self._runs("_committed"), *[n for name in tables for n in self._runs(name)]]
        )

    def _commit(self, run: int) -> None:
        Folder(self.spark, f"{self.root}/_committed/{run}").create()

    def _runs(self, table: str) -> list[int]:
        names = Folder(self.spark, f"{self.root}/{table}").names()
        return [int(name.removeprefix("run=")) for name in names]

    def _newest(self, table: str) -> int | None:
        return max(set(self._runs(table)) & set(self._runs("_committed")), default=None)


@dataclass(frozen=True)
class Change:
    """What a batch does to a keyed table.

    ``keys`` has the key values that the batch touches, in a column named as ``key`` or in
    what ``key_of`` makes of it; ``apply`` makes the new rows from the present ones of the
    touched partitions.
    """

    key: str
    schema: str
    keys: DataFrame
    apply: Callable[[DataFrame], DataFrame]
    key_of: Callable[[Column], Column] = lambda column: column


class KeyedTables:
    """Tables partitioned by a hash of their key; a batch overwrites the partitions it touches.

    New rows of all tables are stored beside them first, so input that does not parse changes
    nothing. Then each table's partitions are overwritten, in the order in which the tables
    are named. A run that dies between them is run again: keyed updates end alike, and a table
    that must not be updated twice comes last. Partitions are fixed when the store begins:
    about as many as the largest table has times 10 GB.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark = spark
        self.root = root.rstrip("/")
        named = Folder(spark, f"{self.root}/_buckets").names()
        self.buckets = int(named[0]) if named else buckets

    def bucket_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def read(self, table: str, schema: str, only: list[int] | None = None) -> DataFrame:
        """Rows of all partitions or of some; an empty table while none was stored."""
        if not Folder(self.spark, f"{self.root}/{table}").exists():
            return empty(self.spark, schema)
        rows = self.spark.read.schema(f"{schema}, bucket INT").parquet(f"{self.root}/{table}")
        return (rows if only is None else rows.where(F.col("bucket").isin(only))).drop("bucket")

    def touched(self, change: Change) -> list[int]:
        """Partitions of a change, at most as many as there are."""
        bucket = self.bucket_of(change.key_of(F.col(change.key)))
        return sorted(row[0] for row in change.keys.select(bucket).distinct().collect())

    def update(self, **changes: Change) -> None:
        """Overwrite the partitions that the changes touch."""
        Folder(self.spark, f"{self.root}/_buckets/{self.buckets}").create()
        new = {}
        for name, change in changes.items():
            touched = self.touched(change)
            rows = change.apply(self.read(name, change.schema, touched))
            bucket = self.bucket_of(change.key_of(F.col(change.key)))
            new[name] = touched, stored(conform(rows, change.schema).withColumn("bucket", bucket))
        for name, (touched, rows) in new.items():
            # Rebalanced: a large partition comes in several files, a small one in one.
            dealt = rows.hint("rebalance", "bucket").write.partitionBy("bucket").mode("overwrite")
            dealt.option("partitionOverwriteMode", "dynamic").parquet(f"{self.root}/{name}")
            # Only partitions with rows are overwritten; what lost its last row goes.
            filled = {row[0] for row in rows.select("bucket").distinct().collect()}
            for number in set(touched) - filled:
                Folder(self.spark, f"{self.root}/{name}/bucket={number}").delete()

    def clear(self, table: str, schema: str) -> bool:
        """Empty a table; False when there is none."""
        if self.read(table, schema).isEmpty():
            return False
        Folder(self.spark, f"{self.root}/{table}").delete()
        return True
