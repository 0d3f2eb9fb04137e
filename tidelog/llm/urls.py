"""URL filter: rules by host and path, then a list of canonical URLs behind a blocked Bloom filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.bloom import blocks_for, with_maybe
from tidelog.llm.common import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without a closing slash, other than tracking parameters in order; null without a host."""
    given = F.split(F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1), "&")
    kept = F.array_join(F.array_sort(F.filter(given, lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    whole = F.concat(F.regexp_replace(host(url), r"^www\.", ""), F.regexp_replace(path(url), "/$", ""),
                     F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))
    return F.when(host(url) != "", whole)


def rule_column(rules: dict[str, str]) -> Column:
    """The longest rule ``host/path`` that fits columns host and path; null if none does.

    A rule fits its host and all hosts below it, if the path starts with the rule's. Rules are a
    configuration of some hundred entries, tried in one expression.
    """
    fits = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        at, slash, below = rule.partition("/")
        here = (F.col("host") == at) | F.col("host").endswith(f".{at}")
        fits = F.when(here & F.col("path").startswith(slash + below), F.lit(rule)).otherwise(fits)
    return fits


def is_listed(pages: DataFrame, listed: DataFrame, name: str = "urls") -> DataFrame:
    """``pages`` with boolean ``listed``: whether column ``key`` is a ``key`` of ``listed``. Null is never listed.

    The blocked Bloom filter lets few others than listed keys through to the hash join that decides.
    """
    keys = Scratch(pages.sparkSession, name).store(listed.select("key").where("key IS NOT NULL").distinct(), "listed")
    probe = with_maybe(pages.where("key IS NOT NULL"), keys, blocks_for(keys.count()))
    exact = probe.where("_maybe").drop("_maybe").join(keys.withColumn("_in", F.lit(True)), "key", "left")
    return (exact.select(*pages.columns, F.coalesce("_in", F.lit(False)).alias("listed"))
            .union(probe.where("NOT _maybe").drop("_maybe").withColumn("listed", F.lit(False)))
            .union(pages.where("key IS NULL").withColumn("listed", F.lit(False))))


def judge(pages: DataFrame, rules: dict[str, str], listed: DataFrame, name: str = "urls") -> DataFrame:
    """(page_id, url, host, path, rule, verdict) for every row: the verdict of the longest fitting rule, else block if listed, else allow.

    ``listed`` has URLs in any form in column url. Null URLs, or URLs without ``://``, have empty
    host and path, fit no rule with a host and are allowed. Repeated rows each give a row; other
    columns of ``pages`` are ignored; an empty list lists nothing.
    """
    parts = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"),
                         canonical(F.col("url")).alias("key")).withColumn("rule", rule_column(rules))
    ruled, open_ = parts.where("rule IS NOT NULL"), parts.where("rule IS NULL")
    verdicts = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair]) if rules else None
    decided = ruled.withColumn("verdict", verdicts[F.col("rule")] if rules else F.lit("allow"))
    tested = is_listed(open_, listed.select(canonical(F.col("url")).alias("key")), name)
    tested = tested.withColumn("verdict", F.when(F.col("listed"), "block").otherwise("allow"))
    columns = ["page_id", "url", "host", "path", "rule", "verdict"]
    return decided.select(columns).union(tested.select(columns))
