"""Table sinks: full-rebuild Parquet tables and month-partitioned panels.

A table is written beside the one it replaces and takes its place in one
switch at the end, so readers and failed jobs never see half a table.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONTH_COL = "date_month"
#: Rows of a month that share a piece before AQE joins small pieces or splits large ones.
ROWS_PER_PIECE = 4_000_000
#: Names of folders that are being written or were just replaced (no reader lists them as tables).
NEW, OLD = "._new-", "._old-"


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm  # the folder may be on any file system that Spark reads
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _beside(path: str, mark: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/{mark}{name}-{uuid.uuid4().hex}"


def _listed(spark: SparkSession, path: str, mark: str) -> list[str]:
    """Folders of ``mark`` beside the table, oldest first."""
    parent, _, name = path.rstrip("/").rpartition("/")
    fs, folder = _file_system(spark, parent)
    if not fs.exists(folder):
        return []
    found = [f for f in fs.listStatus(folder) if f.getPath().getName().startswith(f"{mark}{name}-")
             and len(f.getPath().getName()) == len(f"{mark}{name}-") + 32]
    return [f"{parent}/{f.getPath().getName()}" for f in sorted(found, key=lambda f: f.getModificationTime())]


def replace_table(spark: SparkSession, path: str, write) -> None:
    """``write(folder)`` a table, then put it in the place of ``path``.

    Until the switch (two renames in the file system) the old table is
    untouched; a job that dies between the renames leaves it under its hidden
    name, from where ``recover`` brings it back.  A failed write removes its own
    folder, a killed one leaves it hidden."""
    fresh = _beside(path, NEW)
    fs, new = _file_system(spark, fresh)
    try:
        write(fresh)
    except BaseException:
        fs.delete(new, True)
        raise
    recover(spark, path)
    target = _file_system(spark, path)[1]
    if fs.exists(target) and not fs.rename(target, _file_system(spark, _beside(path, OLD))[1]):
        raise OSError(f"{path} could not be moved aside")
    if not fs.rename(new, target):
        raise OSError(f"{fresh} could not take the place of {path}")
    for left in _listed(spark, path, OLD):
        fs.delete(_file_system(spark, left)[1], True)


def recover(spark: SparkSession, path: str) -> None:
    """Brings the replaced table back if a job died while it switched."""
    fs, target = _file_system(spark, path)
    left = [] if fs.exists(target) else _listed(spark, path, OLD)
    if left:
        fs.rename(_file_system(spark, left[-1])[1], target)


def write_table(df: DataFrame, path: str) -> None:
    """Full rebuild (``materialized='table'``)."""
    replace_table(df.sparkSession, path, lambda folder: df.write.parquet(folder))


def month_rows(rows: DataFrame, date_col: str = "date") -> DataFrame:
    """``_month, _rows``: rows of each month (as many as the calendar has months)."""
    return rows.groupBy(F.trunc(date_col, "MM").alias("_month")).agg(F.count(F.lit(1)).alias("_rows"))


def write_month_partitioned(df: DataFrame, path: str, date_col: str = "date", cluster_col: str = "ticker",
                            months: DataFrame | None = None, rows_per_piece: int = ROWS_PER_PIECE,
                            watch=None) -> None:
    """Partition by month of ``date_col``, cluster by ``cluster_col``.

    ``rebalance`` on the month and a hash bucket of the cluster column:
    ``months`` (as of ``month_rows``, of the table or of one of about its size)
    gives a large month as many buckets as it has ``rows_per_piece``, each with
    its own tickers; other months, and all without ``months``, have one.  AQE
    joins small pieces and splits large ones.  So a large month is never one
    task, small ones do not fall apart into many files, and every file is
    sorted by (ticker, date): a ticker filter skips files and row groups.
    Unlike a range repartition it needs no sampling pass, which would compute
    the whole input twice.  ``watch`` (of ``operators.quality``) counts rows as
    they are written.
    """
    out = month_sorted(df, date_col, cluster_col, months, rows_per_piece, watch)
    replace_table(df.sparkSession, path, lambda folder: out.write.partitionBy(MONTH_COL).parquet(folder))


def month_sorted(df: DataFrame, date_col: str, cluster_col: str, months: DataFrame | None, rows_per_piece: int, watch) -> DataFrame:
    """The rows of ``write_month_partitioned``, dealt and sorted as it writes them."""
    out = df.withColumn(MONTH_COL, F.trunc(F.col(date_col), "MM"))
    bucket = F.lit(0)
    if months is not None:  # a row a month of the calendar, so at most 12 * 9,999
        out = out.join(F.broadcast(months), F.col(MONTH_COL) == F.col("_month"), "left")
        pieces = F.ceil(F.coalesce("_rows", F.lit(1)) / F.lit(rows_per_piece))
        bucket = F.pmod(F.hash(cluster_col), pieces).cast("int")
    out = (out.withColumn("_bucket", bucket).select(*df.columns, MONTH_COL, "_bucket")
           .hint("rebalance", MONTH_COL, "_bucket").drop("_bucket"))
    # counted before the sort: behind the counts Spark would not see its order, and sort again to write the months
    out = out if watch is None else watch.on(out)
    return out.sortWithinPartitions(MONTH_COL, cluster_col, date_col)


def read_panel(spark: SparkSession, path: str, date_from: dt.date | None = None,
               date_to: dt.date | None = None, date_col: str = "date") -> DataFrame:
    """Read a month-partitioned panel; adds the derived month predicate so
    Parquet partition pruning applies to a date-range filter."""
    recover(spark, path)
    df = spark.read.parquet(path)
    if date_from is not None:
        df = df.filter((F.col(MONTH_COL) >= F.lit(date_from.replace(day=1)))
                       & (F.col(date_col) >= F.lit(date_from)))
    if date_to is not None:
        df = df.filter((F.col(MONTH_COL) <= F.lit(date_to.replace(day=1)))
                       & (F.col(date_col) <= F.lit(date_to)))
    return df


def register_tables(spark: SparkSession, out_dir: str, names=None) -> list[str]:
    """Expose built tables under ``out_dir`` as temp views named after the
    models, so they can be queried with Spark SQL (``SELECT ... FROM
    mart_factor_dataset WHERE date_month >= DATE'2012-01-01' ...``)."""
    if names is None:
        fs, path = _file_system(spark, out_dir)
        names = sorted(f.getPath().getName() for f in fs.listStatus(path) if f.isDirectory())
        names = [n for n in names if not n.startswith((".", "_"))]
    for name in names:
        recover(spark, f"{out_dir}/{name}")
        spark.read.parquet(f"{out_dir}/{name}").createOrReplaceTempView(name)
    return list(names)
