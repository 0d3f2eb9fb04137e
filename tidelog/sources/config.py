"""Capture rules and routes from JSON configuration documents."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.values import parse_bool, parse_int
from ..schemas import CONFIG

# --- Fixed values: defaults of absent settings --------------------------------
DEFAULT_CAPTURE = True
DEFAULT_ACTIVE = True
DEFAULT_QUEUE_DEPTH = 1024


def config_document(spark: SparkSession, text: str) -> DataFrame:
    """One document given as text.

    The optimizer knows the size of this relation (unlike that of a Python
    list), so joins with rules and routes made from it broadcast by themselves.
    Documents in files are read with ``spark.read.text(path, wholetext=True)``.
    """
    return spark.sql("SELECT * FROM VALUES (:doc) AS t(doc)", {"doc": text})


def _names(text: Column) -> Column:
    """A list of names given as a JSON array, or a bare string as a list of one."""
    many = F.from_json(text, "array<string>")
    return (
        F.when(text.startswith("["), F.filter(many, lambda n: F.length(n) > 0))
        .when(F.length(text) > 0, F.array(text))
        .otherwise(F.array().cast("array<string>"))
    )


def _first_of_each(entries: Column) -> Column:
    """Entries whose key did not occur earlier in the list: the first one counts."""
    keys = F.transform(entries, lambda e: e["key"])
    return F.filter(entries, lambda e, i: F.array_position(keys, e["key"]) == i + 1)


def _entries(wrappers: Column) -> Column:
    """Key/value pairs of a list of single-key objects, in order."""
    return _first_of_each(F.flatten(F.transform(wrappers, lambda m: F.map_entries(m))))


def _parsed(given: DataFrame) -> DataFrame:
    return given.withColumn("_c", F.from_json("_text", CONFIG, {"mode": "FAILFAST"}))


def _rules(parsed: DataFrame, keep: list[str]) -> DataFrame:
    """Rules of each document, still with its text."""
    per_db = parsed.select(*keep, "_text", F.explode(_entries(F.col("_c.capture.databases"))).alias("_d"))
    per_table = per_db.select(
        *keep, "_text",
        F.col("_d.key").alias("db"),
        parse_bool("_d.value.capture_dml", DEFAULT_CAPTURE).alias("capture_dml"),
        parse_bool("_d.value.capture_ddl", DEFAULT_CAPTURE).alias("capture_ddl"),
        F.explode_outer(_entries(F.col("_d.value.tables"))).alias("_t"),
    )
    columns = F.from_json(F.col("_t.value.columns"), "array<string>")
    every = F.coalesce(columns == F.array(F.lit("*")), F.lit(False))
    empty = F.array().cast("array<string>")
    return per_table.select(
        *keep, "_text", "db", "capture_dml", "capture_ddl",
        F.col("_t.key").alias("table"),
        _names(F.col("_t.value.primary_key")).alias("primary_key"),
        every.alias("all_columns"),
        F.when(every, empty).otherwise(F.coalesce(columns, empty)).alias("columns"),
    )


def rules_tables(docs: DataFrame, column: str = "doc", keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(rules, routes)`` of a table of configuration documents.

    ``rules`` has one row per database and table, and one with a null table for a
    database that lists none; ``routes`` has one row per named publisher.  Several
    documents (with the same ``keep``) are one configuration: the first entry of a
    (database, table) counts, in order of the documents' text.
    ``keep`` names columns of ``docs`` to carry along.  A document that is not JSON
    raises when the tables are read.
    """
    keep = list(keep or [])
    given = docs.select(*keep, F.col(column).alias("_text"))
    parsed = _parsed(given)
    first = Window.partitionBy(*keep, "db", "table").orderBy("_text")

    def chosen(entries: DataFrame) -> DataFrame:
        return entries.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n", "_text")

    if keep:
        # A document alone under its keys names each table once: only documents that share keys are sorted with their text.
        several = given.groupBy(*keep).count().where("count > 1").select(*[F.col(k).alias(f"_keep{i}") for i, k in enumerate(keep)])
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_keep{i}")) for i, k in enumerate(keep)])
        alone = _rules(_parsed(given.join(several, same, "left_anti")), keep).drop("_text")
        rules = alone.unionByName(chosen(_rules(_parsed(given.join(several, same, "left_semi")), keep)))
    else:
        rules = chosen(_rules(parsed, keep))

    plugins = parsed.select(*keep, F.explode("_c.publishers").alias("_p")).select(*keep, "_p.plugin.*")
    routes = plugins.where("name is not null and library_path is not null").select(
        *keep,
        F.col("name").alias("publisher"),
        parse_bool("active", DEFAULT_ACTIVE).alias("active"),
        F.coalesce(F.from_json("publish_databases", "array<string>"), F.array().cast("array<string>")).alias("databases"),
        F.regexp_extract("library_path", r"([A-Za-z0-9]+)_publisher[^/]*$", 1).alias("sink"),
        parse_int("max_queu_depth", DEFAULT_QUEUE_DEPTH).alias("queue_depth"),
        F.coalesce("config", F.create_map().cast("map<string,string>")).alias("options"),
    )
    return rules, routes
