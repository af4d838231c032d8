"""Reading the tables and naming their rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratewise.session import checkpointed

FEW_KEYS = 10_000

# A row of the input, whatever ids the table repeats.
ROW = "row_no"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame) -> DataFrame:
    """Give every row a number; store the result before the numbers are used twice."""
    return df.withColumn(ROW, F.monotonically_increasing_id())


def thinned(df: DataFrame, keys: list[str], order: Column, n: int) -> DataFrame:
    """Rows among which the first ``n`` of every key by a hash ``order`` surely are.

    About three times as many of a key are kept as are asked for, so that the choice that
    follows is small whatever the number of rows and tasks.
    """
    counts = checkpointed(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows")))
    # Few keys meet the rows where these are; else one key's rows would meet in one task.
    counts = F.broadcast(counts) if counts.count() <= FEW_KEYS else counts
    unit = (F.shiftrightunsigned(order, 34).cast("double") + 1) / (1 << 30)
    wanted = F.greatest(F.lit(3 * n), F.lit(1000))
    return df.join(counts, keys).where(unit * F.col("key_rows") <= wanted).drop("key_rows")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
