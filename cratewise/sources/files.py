"""CSV files exchanged with the lookup service, and the run summary."""

from __future__ import annotations

import datetime as dt
import logging
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratewise.functions.documents import STRICT
from cratewise.sources.folders import Folder

log = logging.getLogger(__name__)

# Quotes inside a field are doubled and a field may hold line ends and outer spaces.
_WRITE = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
_READ = {"header": True, "escape": '"', "enforceSchema": False, **STRICT}

# Marks a folder in whose files every record is one line.
_ONE_LINE = "_one_line"


def one_line(document: Column) -> Column:
    """A JSON document without line ends, which it can hold only between its parts."""
    return F.translate(document, "\r\n", "  ")


def write_csv(df: DataFrame, path: str) -> None:
    """Write with a header line, also when there are no rows.

    Where no field holds a line end the folder is marked, so that its files are read in
    splits; ``df`` is read twice for it.
    """
    texts = [name for name, kind in df.dtypes if kind == "string"]
    broken = reduce(or_, [F.col(name).rlike("[\r\n]") for name in texts], F.lit(False))
    df.write.mode("overwrite").csv(path, **_WRITE)
    if df.where(broken).isEmpty():
        Folder(df.sparkSession, f"{path}/{_ONE_LINE}").create()


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """Rows of a file or folder with the columns of ``schema``; None when it is absent.

    Empty fields are NULL, quoted or not. A row with more or fewer fields than the header
    stops the query. A file is read in splits if it is marked as having one line a record,
    else by one task.
    """
    if not Folder(spark, path).exists():
        log.info("no file at %s, skipped", path)
        return None
    whole = not Folder(spark, f"{path}/{_ONE_LINE}").exists()
    return spark.read.csv(path, schema=schema, multiLine=whole, **_READ)


def export_queue(queue: DataFrame, path: str) -> None:
    """The queue, sorted by code and track.

    One code may bring any number of tracks, so the file stays in sorted parts.
    """
    columns = ["track_id", "isrc", "isrc_queue_rank", "isrc_track_rank"]
    write_csv(queue.select(*columns).orderBy("isrc", "track_id"), path)


def run_summary(
    outputs: dict[str, DataFrame], generated_at: dt.datetime, codes: DataFrame
) -> DataFrame:
    """Row count of every output, with the time of the run and the number of codes asked for."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("output_name"), "row_count"
        )
        for name, df in outputs.items()
    ]
    processed = codes.agg(F.countDistinct("isrc")).scalar()
    return reduce(DataFrame.unionByName, counts).withColumns(
        {"generated_at": F.lit(generated_at.isoformat()), "processed_isrcs": processed}
    )
