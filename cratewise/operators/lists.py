"""Groups listed in an order, an element a row, so that no cell grows with its group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratewise.operators.ranking import UNMEASURED, number_within
from cratewise.operators.skew import HOT_GROUP_ROWS
from cratewise.session import stored

POSITION = "position"
# Elements put in order by one task at a time, and bytes of a cell; Spark's limit is 2 GB.
BLOCK_ROWS = 10_000
CELL_BYTES = 1 << 30


def ordered_elements(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    values: dict[str, Column],
    hot: DataFrame | None | object = UNMEASURED,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Values of every group in a total order, numbered from 1, NULL elements kept."""
    columns = [column.alias(name) for name, column in values.items()]
    numbered = number_within(df, keys, order, POSITION, hot, hot_rows)
    return numbered.select(*keys, POSITION, *columns)


def filled_elements(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    value: Column,
    out: str,
    hot: DataFrame | None | object = UNMEASURED,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Values of every group in a total order, numbered from 1, NULL ones left out."""
    filled = df.withColumn(out, value).where(F.col(out).isNotNull())
    return ordered_elements(filled, keys, order, {out: F.col(out)}, hot, hot_rows)


def distinct_elements(
    df: DataFrame, keys: list[str], value: str, hot_rows: int = HOT_GROUP_ROWS
) -> DataFrame:
    """Distinct non-NULL texts of every group without regard to case in order, numbered from 1."""
    pairs = stored(df.where(F.col(value).isNotNull()).select(*keys, value).distinct())
    order = [F.lower(value).asc(), F.col(value).asc()]
    return ordered_elements(pairs, keys, order, {value: F.col(value)}, hot_rows=hot_rows)


def assembled(
    elements: DataFrame,
    keys: list[str],
    values: list[str],
    block_rows: int = BLOCK_ROWS,
    cell_bytes: int = CELL_BYTES,
) -> DataFrame:
    """Elements of every key in one array of structs, ``elements``, in the order of positions.

    For what leaves the library in the published shape. Blocks of elements are put in order
    first, then the blocks of a key. A key whose elements would not fit a cell stops the query
    with its name before anything of it is put together.
    """
    size = sum((F.coalesce(F.octet_length(F.col(v).cast("string")), F.lit(0)) for v in values), F.lit(16))
    block = F.floor((F.col(POSITION) - 1) / block_rows).alias("block")
    blocks = stored(
        elements.groupBy(*keys, block).agg(
            F.sort_array(F.collect_list(F.struct(POSITION, *values))).alias("listed"),
            F.sum(size.cast("bigint")).alias("bytes"),
        )
    )
    large = blocks.groupBy(*keys).agg(F.sum("bytes").alias("bytes")).where(F.col("bytes") > cell_bytes)
    if found := large.first():
        named = {key: found[key] for key in keys}
        raise ValueError(f"a list of {found['bytes']} bytes does not fit a cell: {named}")
    ordered = F.sort_array(F.collect_list(F.struct("block", "listed")))["listed"]
    whole = blocks.groupBy(*keys).agg(F.flatten(ordered).alias("elements"))
    pick = lambda x: F.struct(*[x[v].alias(v) for v in values])
    return whole.withColumn("elements", F.transform("elements", pick))


def newest_filled(value: Column, timestamp: Column) -> Column:
    """Aggregate: the value at the latest timestamp among rows that have both."""
    both = value.isNotNull() & timestamp.isNotNull()
    # Equal timestamps: the greater value, so that the result does not depend on order.
    return F.max(F.when(both, F.struct(timestamp.alias("at"), value.alias("value"))))["value"]
