"""Queries with hundreds of subscribers and patterns, taken from the parts table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.subscriptions import selected, subscribed
from .registry import query, table

TOPIC = "concat(lower(p_brand), '.', replace(lower(p_type), ' ', '_'), '.', cast(p_size as string))"
SQL_TOPIC = "lower(p_brand) || '.' || replace(lower(p_type), ' ', '_') || '.' || p_size"


def topics(spark, sf):
    return table(spark, sf, "part").selectExpr("p_partkey", f"{TOPIC} as topic")


@query("subscribers_by_prefix", f"""WITH M AS (SELECT p_partkey, {SQL_TOPIC} AS topic FROM part),
S AS (SELECT DISTINCT 's' || p_partkey % 300 AS subscriber, substr(topic, 1, 6 + p_partkey % 20) AS prefix FROM M WHERE p_partkey % 5 = 0)
SELECT DISTINCT p_partkey, topic, subscriber FROM M JOIN S ON starts_with(topic, prefix)""")
def by_prefix(spark, sf):
    """Some hundred subscriptions in one join."""
    messages = topics(spark, sf)
    subscriptions = messages.where("p_partkey % 5 = 0").select(
        F.concat(F.lit("s"), (F.col("p_partkey") % 300).cast("string")).alias("subscriber"),
        F.expr("substring(topic, 1, cast(6 + p_partkey % 20 as int))").alias("prefix"))
    return subscribed(messages, subscriptions)


@query("topics_by_patterns", f"""WITH M AS (SELECT p_partkey, {SQL_TOPIC} AS topic FROM part),
G AS (SELECT DISTINCT CASE p_partkey % 3 WHEN 0 THEN substr(topic, 1, 9) || '*' || right(topic, 2) WHEN 1 THEN '*' || right(topic, 7)
        ELSE substr(topic, 1, 7) || '?' || substr(topic, 9) END AS pat, p_partkey % 8 <> 0 AS include FROM M WHERE p_partkey % 4 = 0)
SELECT p_partkey, topic FROM M WHERE EXISTS (SELECT 1 FROM G WHERE include AND topic GLOB pat) AND NOT EXISTS (SELECT 1 FROM G WHERE NOT include AND topic GLOB pat)""")
def by_patterns(spark, sf):
    """Tables of including and excluding patterns (F8)."""
    messages = topics(spark, sf)
    patterns = messages.where("p_partkey % 4 = 0").selectExpr(
        """case p_partkey % 3 when 0 then concat(substring(topic, 1, 9), '*', right(topic, 2)) when 1 then concat('*', right(topic, 7))
                else concat(substring(topic, 1, 7), '?', substring(topic, 9)) end as glob""",
        "p_partkey % 8 <> 0 as include")
    return selected(messages, patterns.distinct())
