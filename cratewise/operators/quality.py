"""Checks over finished tables. Each returns rows to report, and stops nothing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratewise.functions.moments import moment, safe_timestamp
from cratewise.operators.skew import BROADCAST_ROWS
from cratewise.session import checkpointed

# Hours after which a landing table is stale.
WARN_HOURS = 48
ERROR_HOURS = 168


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Rows without a value, per column, in one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(column).isNull()).alias(column) for column in columns])
    named = F.array(
        *[
            F.struct(F.lit(column).alias("column_name"), F.col(column).alias("failing_rows"))
            for column in columns
        ]
    )
    return counts.select(F.lit(table).alias("table_name"), F.inline(named))


def unique(
    df: DataFrame,
    table: str,
    columns: list[str],
    mark: Callable[[Column], Column] = F.xxhash64,
    few: int = BROADCAST_ROWS,
) -> DataFrame:
    """Values that occur more than once, per column, in one pass; NULL is not compared.

    64-bit marks of the cells are counted first, so that no text is shuffled. Only cells whose
    mark repeats are compared themselves: there are none in a table as it should be, and they
    are found where they lie if their marks are few.
    """
    cell = lambda column: F.col(column).cast("string")
    marks = F.array(
        *[
            F.struct(F.lit(i).alias("column_no"), F.when(cell(c).isNotNull(), mark(cell(c))).alias("mark"))
            for i, c in enumerate(columns)
        ]
    )
    counted = df.select(F.inline(marks)).where("mark is not null").groupBy("column_no", "mark")
    repeated = checkpointed(counted.count().where("count > 1").drop("count"))
    n = repeated.count()
    named = df.sparkSession.createDataFrame(list(enumerate(columns)), "column_no int, column_name string")
    values = F.lit(0).cast("bigint")
    if n:
        cells = F.array(
            *[
                F.struct(F.lit(i).alias("column_no"), mark(cell(c)).alias("mark"), cell(c).alias("cell"))
                for i, c in enumerate(columns)
            ]
        )
        suspects = df.select(F.inline(cells)).where("cell is not null")
        suspects = suspects.join(
            F.broadcast(repeated) if n <= few else repeated, ["column_no", "mark"], "left_semi"
        )
        same = suspects.groupBy("column_no", "cell").count().where("count > 1")
        found = same.groupBy("column_no").agg(F.count(F.lit(1)).alias("repeated_values"))
        named = named.join(found, "column_no", "left")
        values = F.coalesce("repeated_values", values)
    return named.select(F.lit(table).alias("table_name"), "column_name", values.alias("repeated_values"))


def freshness(df: DataFrame, table: str, loaded_at: str, as_of: dt.datetime) -> DataFrame:
    """Newest load time of a landing table and whether it is still fresh."""
    newest = df.agg(F.max(F.expr(safe_timestamp(loaded_at))).alias("max_loaded_at"))
    now = moment(as_of)
    loaded = F.col("max_loaded_at")
    status = (
        F.when(loaded.isNull() | (loaded < now - F.expr(f"INTERVAL {ERROR_HOURS} HOURS")), "error")
        .when(loaded < now - F.expr(f"INTERVAL {WARN_HOURS} HOURS"), "warn")
        .otherwise("pass")
    )
    return newest.select(F.lit(table).alias("table_name"), "max_loaded_at", status.alias("status"))
