"""A position index of a log kept as tables: which data file holds which places.

One row per data file and log file: smallest and largest position and the number of events. The
index lives beside the log, grows by the files that it does not know yet, and answers where the log
ends and which files a start needs, so that neither has to read the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.order import file_no
from ..operators.position import after, parse_mark

SCHEMA = "path STRING, log_file STRING, file_no BIGINT, first BIGINT, last BIGINT, events BIGINT"
# Not listed with the data, as its name begins with an underscore.
FOLDER = "_positions"
EARLIEST, LATEST = "earliest", "latest"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of that name, on whatever file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)


def position_index(spark: SparkSession, log: str) -> DataFrame:
    """The index as it is stored; empty if there is none."""
    folder = f"{log.rstrip('/')}/{FOLDER}"
    return spark.read.schema(SCHEMA).parquet(folder) if exists(spark, folder) else spark.createDataFrame([], SCHEMA)


def update_index(spark: SparkSession, log: str, fmt: str = "parquet") -> DataFrame:
    """Add the data files that the index lacks, by one aggregate over two columns of these files alone.

    Data files are written once, as Spark writes them. A run that is repeated adds nothing twice:
    the entries of a file are one file of the index only once all are there.
    """
    log = log.rstrip("/")
    listed = spark.createDataFrame([(p,) for p in sorted(spark.read.format(fmt).load(log).inputFiles())], "path STRING")
    # Listings and file metadata write the slashes after the scheme in different ways.
    same = F.regexp_replace("path", "^([a-z0-9]+:)/+", "$1/").alias("same")
    known = position_index(spark, log).select(same).distinct()
    new = [r.path for r in listed.withColumn("same", same).join(known, "same", "left_anti").collect()]
    if new:
        rows = spark.read.format(fmt).option("basePath", log).load(new).select(F.col("_metadata.file_path").alias("path"), "log_file", "position")
        entries = rows.groupBy("path", "log_file").agg(
            F.min("position").alias("first"), F.max("position").alias("last"), F.count("*").alias("events"))
        entries.select("path", "log_file", file_no().alias("file_no"), "first", "last", "events").coalesce(1).write.mode("append").parquet(f"{log}/{FOLDER}")
    return position_index(spark, log)


def end_mark(index: DataFrame) -> tuple[str, int] | None:
    """The last place of the log; none if the log is empty."""
    last = index.agg(F.max(F.struct("file_no", "last", "log_file")).alias("m")).first().m
    return (last.log_file, last.last) if last else None


def resolve_start(index: DataFrame, checkpoint: tuple[str, int] | str | None = None, start: tuple[str, int] | str | None = None) -> tuple[str, int] | None:
    """The place after which to read: the checkpoint's, else the configured one, else the current end; none is the beginning."""
    if checkpoint is not None:
        return parse_mark(checkpoint) if isinstance(checkpoint, str) else checkpoint
    if start == EARLIEST:
        return None
    if start is None or start == LATEST:
        return end_mark(index)
    return parse_mark(start) if isinstance(start, str) else start


def needed_files(index: DataFrame, mark: tuple[str, int] | None) -> list[str]:
    """Data files with places after the mark."""
    if mark is not None:
        number = index.sparkSession.range(1).select(file_no(f"'{mark[0]}'").alias("n")).first().n
        index = index.where((F.col("file_no") > number) | ((F.col("file_no") == number) & (F.col("last") > mark[1])))
    return [r.path for r in index.select("path").distinct().orderBy("path").collect()]


def read_from(spark: SparkSession, log: str, checkpoint: tuple[str, int] | str | None = None, start: tuple[str, int] | str | None = None,
              fmt: str = "parquet") -> DataFrame:
    """Events after the resolved start, from the data files that hold any; files the index does not know are added first."""
    index = update_index(spark, log, fmt)
    mark = resolve_start(index, checkpoint, start)
    files = needed_files(index, mark)
    whole = spark.read.format(fmt).option("basePath", log.rstrip("/"))
    if not files:
        return whole.load(log).limit(0)
    events = whole.load(files)
    return events if mark is None else after(events, mark)
