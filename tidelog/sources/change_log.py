"""Change-log sources, batch and streaming."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.envelope import parse_envelope
from ..operators.filters import payload_status
from ..schemas import DDL_CLASSES, DML_KINDS


def parse_change_log(raw: DataFrame, column: str = "json") -> DataFrame:
    """Typed columns of a table of change documents.

    ``status`` tells usable documents from empty and invalid ones; nothing is
    dropped.  ``kind`` is the event kind and ``table`` the routing name, so parsed
    logs go through the same operators as built ones.
    """
    doc = F.col("_doc")
    kind = (
        F.when(doc["type"].isin(DML_KINDS), doc["type"])
        .when(doc["type"] == "COMMIT", "XID")
        .when(doc["type"].isin(DDL_CLASSES), "QUERY")
    )
    others = [c for c in raw.columns if c != column]
    return raw.withColumn("_doc", parse_envelope(F.col(column))).select(
        *others,
        F.col(column).alias("json"),
        payload_status(column).alias("status"),
        kind.alias("kind"),
        doc["type"].alias("type"), doc["txn"].alias("txn"), doc["db"].alias("db"),
        F.when(doc["type"].isin(DML_KINDS), doc["table"]).otherwise(doc["type"]).alias("table"),
        doc["primary_key"].alias("primary_key"), doc["rows"].alias("rows"),
        doc["query"].alias("query"), doc["xid"].alias("xid"),
    )


def read_change_log(spark: SparkSession, path: str | list[str], fmt: str = "text") -> DataFrame:
    """A change log at rest.

    ``text`` holds one JSON document per line; ``parquet``, ``orc`` and the like hold
    change-event tables and are returned as they are, so column pruning and
    pushed filters reach the files.
    """
    if fmt == "text":
        return parse_change_log(spark.read.text(path).withColumnRenamed("value", "json"))
    return spark.read.format(fmt).load(path)


def read_change_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "text",
    schema: str | None = None,
    max_files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """The same log as a stream; ``max_files_per_trigger`` limits the rate, never drops."""
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.options(**options).load(path)
    return parse_change_log(stream.withColumnRenamed("value", "json")) if fmt == "text" else stream


def read_kafka(spark: SparkSession, servers: str, topics: str, stream: bool = False,
               starting: str = "earliest", max_offsets_per_trigger: int | None = None,
               **options: str) -> DataFrame:
    """Kafka topics by list or pattern; needs Spark's Kafka connector on the class path.

    ``starting`` is ``earliest``, ``latest`` or offsets per partition as JSON; a stream
    that has a checkpoint goes on from there instead.
    """
    if stream and max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    how = "subscribePattern" if any(ch in topics for ch in "*?[](|\\") else "subscribe"
    reader = (spark.readStream if stream else spark.read).format("kafka")
    return parse_kafka(
        reader.option("kafka.bootstrap.servers", servers)
        .option(how, topics)
        .option("startingOffsets", starting)
        .options(**options)
        .load()
    )


def parse_kafka(records: DataFrame) -> DataFrame:
    """Change events from Kafka records: value is the document, key the transaction."""
    text = records.select(
        "topic", "partition", "offset", "timestamp",
        F.col("key").cast("string").alias("record_key"), F.col("value").cast("string").alias("json"),
    )
    parsed = parse_change_log(text)
    return parsed.withColumn("txn", F.coalesce("record_key", "txn")).drop("record_key")


def union_streams(*streams: DataFrame) -> DataFrame:
    """Several streams or tables read as one, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), streams)


def table_columns(spark: SparkSession, db: str, table: str) -> DataFrame:
    """Column names and types of a catalog table, one row per column."""
    return schema_columns(spark.table(f"`{db}`.`{table}`"), db, table)


def schema_columns(df: DataFrame, db: str, table: str) -> DataFrame:
    """The same for any table at hand, from its schema alone: no row is read."""
    spark, fields = df.sparkSession, df.schema.fields
    rows = [(db, table, i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)]
    return spark.createDataFrame(rows, "db STRING, `table` STRING, ordinal INT, name STRING, type STRING")


def observed_columns(ev: DataFrame) -> DataFrame:
    """Column names seen in the row images of each table of a log."""
    image = F.explode("rows").alias("_row")
    names = F.when(
        F.col("kind") == "UPDATE", F.map_keys(F.col("_row")["after"].cast("map<string,variant>"))
    ).otherwise(F.map_keys("_row"))
    return (
        ev.where(F.col("kind").isin(DML_KINDS))
        .select("kind", "db", "table", image)
        .select("db", "table", F.explode(names).alias("name"))
        .distinct()
    )
