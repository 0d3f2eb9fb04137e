"""Queries over value decoding and lenient settings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import values
from ..operators.decode import ColumnType, decode_columns
from .registry import query, table


@query("int24", """SELECT l_orderkey, l_partkey, l_linenumber, CAST(CASE WHEN v >= 8388608 THEN v - 16777216 ELSE v END AS INTEGER) AS v
FROM (SELECT *, (l_partkey * 7919 + l_orderkey * 31 + l_linenumber) % 16777216 AS v FROM lineitem)""")
def signed24(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        values.int24(F.expr("(l_partkey * 7919 + l_orderkey * 31 + l_linenumber) % 16777216")).alias("v"))


@query("unsigned_view", """SELECT o_orderkey, CASE WHEN a < 0 THEN a + 4294967296 ELSE a END AS u32,
  CAST(CASE WHEN b < 0 THEN CAST(b AS HUGEINT) + 18446744073709551616 ELSE b END AS VARCHAR) AS u64 FROM (
  SELECT o_orderkey, (o_orderkey * 2654435761) % 4294967296 - 2147483648 AS a,
    (o_orderkey % 2 * 2 - 1) * (o_orderkey * 123456789123 + 1) AS b FROM orders)""")
def unsigned(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey", "(o_orderkey * 2654435761) % 4294967296 - 2147483648 as a",
        "(o_orderkey % 2 * 2 - 1) * (o_orderkey * 123456789123 + 1) as b",
    ).select("o_orderkey", values.as_unsigned("a", 32).alias("u32"), values.as_unsigned("b", 64).cast("string").alias("u64"))


# Packed bytes of a time column, as the log stores them.
MICROS = "pmod(unix_micros(cast(ts as timestamp)), 1000000)"
PACKED = """unhex(lpad(hex(shiftleft(1L, 39) + shiftleft(cast(year(ts) * 13 + month(ts) as bigint), 22)
    + shiftleft(cast(day(ts) as bigint), 17) + shiftleft(cast(hour(ts) as bigint), 12)
    + shiftleft(cast(minute(ts) as bigint), 6) + cast(floor(second(ts)) as bigint)), 10, '0'))"""


def fraction(fsp: int) -> str:
    width = (fsp + 1) // 2
    return f"unhex(lpad(hex({MICROS} div {10 ** (6 - 2 * width)}), {2 * width}, '0'))"


@query("datetime2", """SELECT event_id, date_trunc('second', ts) AS whole, date_trunc('second', ts) + to_microseconds(microsecond(ts) % 1000000 // 100 * 100) AS short,
  ts AS long FROM events""")
def packed_datetime(spark, sf):
    raw = table(spark, sf, "events").selectExpr(
        "event_id", f"{PACKED} as p0", f"{PACKED} || {fraction(4)} as p4", f"{PACKED} || {fraction(6)} as p6")
    return raw.select("event_id", values.datetime2("p0").alias("whole"), values.datetime2("p4", 4).alias("short"),
                      values.datetime2("p6", 6).alias("long"))


@query("timestamp2", """SELECT event_id, date_trunc('second', ts) AS whole, date_trunc('second', ts) + to_microseconds(microsecond(ts) % 1000000 // 10000 * 10000) AS short,
  ts AS long FROM events""")
def epoch_timestamp(spark, sf):
    raw = table(spark, sf, "events").selectExpr(
        "event_id", "unix_seconds(cast(ts as timestamp)) as s", f"{MICROS} as us", f"{MICROS} div 10000 as hundredths")
    return raw.select(
        "event_id", values.timestamp2("s").cast("timestamp_ntz").alias("whole"),
        values.timestamp2("s", "hundredths", 2).cast("timestamp_ntz").alias("short"),
        values.timestamp2("s", "us", 6).cast("timestamp_ntz").alias("long"))


@query("fixed6", "SELECT event_id, printf('%.6f', value) AS v, printf('%.6f', -value / 7) AS w FROM events")
def six(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", values.fixed6("value").alias("v"), values.fixed6(-F.col("value") / 7).alias("w"))


WORDS = ["1", "TRUE", " yes", "On", "0", "No", "off", "False", "maybe", "", " ", "2", "true "]
WORD_LIST = "[" + ", ".join(f"'{w}'" for w in WORDS) + "]"


@query("parse_bool", f"""SELECT event_id, word, lower(ltrim(word)) IN ('1', 'true', 'yes', 'on') AS or_false,
  CASE WHEN lower(ltrim(word)) IN ('0', 'false', 'no', 'off') THEN false ELSE true END AS or_true FROM (
  SELECT event_id, list_extract({WORD_LIST}, event_id % {len(WORDS)} + 1) AS word FROM events)""")
def booleans(spark, sf):
    words = "array(" + ", ".join(f"'{w}'" for w in WORDS) + ")"
    raw = table(spark, sf, "events").selectExpr(
        "event_id", f"element_at({words}, cast(event_id % {len(WORDS)} + 1 as int)) as word")
    return raw.select("event_id", "word", values.parse_bool("word").alias("or_false"),
                      values.parse_bool("word", True).alias("or_true"))


@query("parse_int", """SELECT event_id, CAST(CASE event_id % 6 WHEN 0 THEN user_id WHEN 1 THEN -user_id WHEN 2 THEN user_id
  WHEN 3 THEN 0 WHEN 4 THEN 0 ELSE 77 END AS INTEGER) AS v FROM events""")
def integers(spark, sf):
    raw = table(spark, sf, "events").selectExpr("event_id", """case event_id % 6 when 0 then concat(user_id, '')
        when 1 then concat('  -', user_id, ' rest') when 2 then concat('+', user_id, '.9')
        when 3 then concat('x', user_id) when 4 then '' end as text""")
    return raw.select("event_id", values.parse_int("text", 77).alias("v"))


@query("stream_id_time", """SELECT event_id, CASE WHEN event_id % 9 = 0 THEN '??:??:??' ELSE strftime(ts, '%H:%M:%S') END AS at FROM events""")
def id_time(spark, sf):
    ids = table(spark, sf, "events").selectExpr(
        "event_id", "case when event_id % 18 = 0 then null when event_id % 9 = 0 then concat('x', event_id, '-1') "
        "else concat(unix_millis(cast(ts as timestamp)), '-', event_id % 3) end as id")
    return ids.select("event_id", values.stream_id_time("id").alias("at"))


@query("syslog_pri", """SELECT event_id, CAST(
  CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 16 + event_id % 8 ELSE 16 END * 8 +
  CASE WHEN user_id % 9 = 8 THEN 6 ELSE user_id % 9 END AS INTEGER) AS pri FROM events""")
def pri(spark, sf):
    named = table(spark, sf, "events").selectExpr(
        "event_id",
        "case event_id % 4 when 0 then 'LOG_USER' when 1 then 'LOG_DAEMON' when 2 then concat('LOG_LOCAL', event_id % 8) end as f",
        "element_at(array('LOG_EMERG', 'LOG_ALERT', 'LOG_CRIT', 'LOG_ERR', 'LOG_WARNING', 'LOG_NOTICE', 'LOG_INFO', "
        "'LOG_DEBUG', 'local0'), cast(user_id % 9 + 1 as int)) as p")
    return named.select("event_id", values.syslog_pri("f", "p").alias("pri"))


@query("decode_columns", """SELECT event_id, CAST(event_id % 256 - 128 AS TINYINT) AS tiny, CAST(event_id % 256 AS SMALLINT) AS utiny,
  CAST(event_id % 70000 - 35000 AS INTEGER) AS i24, event_id * 7 + 2147483648 AS u32,
  CAST(1950 + event_id % 100 AS SMALLINT) AS yr, printf('%.6f', value) AS amount, ts AS stamp, ts AS dt,
  event_type AS name, props AS memo,
  CASE event_type WHEN 'click' THEN 'click' WHEN 'view' THEN 'view' ELSE '9' END AS label, value AS other FROM events""")
def typed(spark, sf):
    raw = table(spark, sf, "events").selectExpr(
        "event_id", "event_id % 256 - 128 as tiny",
        "event_id % 256 - if(event_id % 256 > 127, 256, 0) as utiny",
        "pmod(event_id % 70000 - 35000, 16777216) as i24",
        "event_id * 7 - 2147483648 as u32", "50 + event_id % 100 as yr", "value as amount",
        f"unhex(lpad(hex(unix_seconds(cast(ts as timestamp))), 8, '0')) || {fraction(6)} as stamp",
        f"{PACKED} || {fraction(6)} as dt", "cast(event_type as binary) as name", "cast(props as binary) as memo",
        "case event_type when 'click' then 1 when 'view' then 2 else 9 end as label", "value as other")
    labels = table(spark, sf, "events").where("event_type in ('click', 'view')").selectExpr(
        "'app' as db", "'visits' as `table`", "'label' as `column`",
        "case event_type when 'click' then 1 else 2 end as ordinal", "event_type as label").distinct()
    types = [
        ColumnType("tiny", "TINY"), ColumnType("utiny", "TINY", unsigned=True), ColumnType("i24", "INT24"),
        ColumnType("u32", "LONG", unsigned=True), ColumnType("yr", "YEAR"), ColumnType("amount", "DOUBLE", text=True),
        ColumnType("stamp", "TIMESTAMP2", fsp=6), ColumnType("dt", "DATETIME2", fsp=6), ColumnType("name", "VARCHAR"),
        ColumnType("memo", "BLOB", preview=True), ColumnType("label", "ENUM"),
    ]
    out = decode_columns(raw, types, labels, "app", "visits")
    return out.withColumn("stamp", F.col("stamp").cast("timestamp_ntz"))
