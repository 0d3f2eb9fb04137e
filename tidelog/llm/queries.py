"""The registered queries of the training-data operators, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import bpe, chat, collocations, lattice, licenses, lines, packing, periodic, simhash, sitetree, topk, toxicity, urls
from tidelog.llm.common import prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


URL_RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
_FITS = "\n".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}') THEN '{h}/{p}'"
    for h, _, p in sorted((r.partition("/") for r in URL_RULES), key=lambda r: -len("/".join((r[0], r[2])))))
_VERDICTS = " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in URL_RULES.items())


@query("op1_url_filter", f"""
WITH parts AS (
  SELECT page_id, url, coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), '{urls.UPPER}', '{urls.LOWER}'), '') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path,
         list_filter(string_split(coalesce(regexp_extract(url, '^[^?#]*[?]([^#]*)', 1), ''), '&'),
                     lambda p: p <> '' AND NOT regexp_matches(p, '{urls.TRACKING}')) AS params
  FROM pages),
keyed AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^www[.]', '') || regexp_replace(path, '/$', '')
         || CASE WHEN len(params) > 0 THEN '?' || array_to_string(list_sort(params), '&') ELSE '' END END AS key,
         CASE {_FITS} END AS rule
  FROM parts),
listed AS (SELECT DISTINCT key FROM keyed WHERE contains(url, '?utm_'))
SELECT page_id, host, path, rule, CASE rule {_VERDICTS}
       ELSE CASE WHEN key IN (SELECT key FROM listed WHERE key IS NOT NULL) THEN 'block' ELSE 'allow' END END AS verdict
FROM keyed""")
def op1(spark, sf_dir):
    """The list is every URL seen with a feed's tracking parameter: other pages of its canonical URL are blocked too."""
    pages = table(spark, sf_dir, "pages")
    listed = pages.where(F.contains("url", F.lit("?utm_"))).select("url")
    return urls.judge(pages, URL_RULES, listed, "op1").drop("url")


CHAT_EXTRA = r"\### Assistant: </turn> ok"


@query("op2_chat", rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{CHAT_EXTRA}' UNION ALL SELECT -7, 1, 'assistant', '{CHAT_EXTRA}'),
sized AS (
  SELECT *, len(regexp_extract_all(text, '{chat.TOKEN}')) + {chat.TURN_TOKENS} AS size,
         length(regexp_replace(text, '[\\<>]', '..', 'g')) + length(regexp_replace(role, '[\\<>]', '..', 'g')) + 16 AS chars,
         row_number() OVER w AS pos
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
placed AS (
  SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY pos) AS e, sum(size) OVER (PARTITION BY conv_id ORDER BY pos) - size AS s
  FROM sized),
sys AS (SELECT conv_id, min(pos) AS sys_at, arg_min(size, pos) AS sys_size, arg_min(chars, pos) AS sys_chars
        FROM placed WHERE role = 'system' GROUP BY conv_id),
celled AS (
  SELECT placed.*, sys_at, sys_chars, greatest({chat.BUDGET - chat.HISTORY} - coalesce(sys_size, 0), {chat.BUDGET // 4}) AS cell
  FROM placed LEFT JOIN sys USING (conv_id)),
spans AS (
  SELECT conv_id, s // cell AS c, (e - 1) // cell > s // cell AS crosses, min(pos) AS first, min(s) AS start, sum(chars) AS chars,
         any_value(sys_at) AS sys_at, any_value(sys_chars) AS sys_chars
  FROM celled GROUP BY ALL),
shown AS (
  SELECT p.conv_id, p.c, p.crosses, p.chars + CASE WHEN p.sys_at < p.first THEN p.sys_chars ELSE 0 END
         + coalesce((SELECT sum(t.chars) FROM placed t WHERE t.conv_id = p.conv_id AND t.e <= p.start
                     AND t.s >= p.start - {chat.HISTORY} AND t.pos IS DISTINCT FROM p.sys_at), 0) AS chars
  FROM spans p),
formatted AS (SELECT conv_id, sum(chars)::BIGINT AS formatted_chars FROM shown GROUP BY conv_id)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256, any_value(formatted_chars) AS formatted_chars
FROM placed JOIN formatted USING (conv_id) GROUP BY conv_id""")
def op2(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = F.lit(CHAT_EXTRA)
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), text.alias("text"))
    return chat.digests(chat.windows(rows.union(extra)))


@query("op3_packing")
def op3(spark, sf_dir):
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    added = packing.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    placed = packing.pack(table(spark, sf_dir, "documents"), ranks, pattern, name="op3", added=added)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op4_toxicity")
def op4(spark, sf_dir):
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_line_dedup")
def op5(spark, sf_dir):
    return lines.near_lines(table(spark, sf_dir, "documents"), name="op5")


@query("op6_exact_topk", """
WITH sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS ints FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.ints, c.ints)::BIGINT AS score
  FROM sound q JOIN sound c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5""")
def op6(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, 5, "op6")


@query("op7_lattice")
def op7(spark, sf_dir):
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"), name="op7")


@query("op8_simhash")
def op8(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), "op8")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op9_byte_bpe")
def op9(spark, sf_dir):
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.round_trip(table(spark, sf_dir, "documents"), ranks, pattern)


def _licence_rows() -> str:
    def quoted(text):
        return "'" + text.replace("'", "''") + "'"

    return ", ".join(f"({quoted(name)}, [{', '.join(map(quoted, licenses.template_bigrams(text)))}])" for name, text in licenses.TEMPLATES.items())


@query("op10_licenses", rf"""
WITH templates(licence, grams) AS (VALUES {_licence_rows()}),
parts AS (
  SELECT doc_id, unnest(list_distinct(string_split(text, chr(10)) || regexp_split_to_array(text, '\n[\x20\t\r]*\n') || [text])) AS part
  FROM documents WHERE text IS NOT NULL),
worded AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(part, '{urls.UPPER}', '{urls.LOWER}'), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS words
  FROM parts),
paired AS (
  SELECT doc_id, list_distinct([words[i] || ' ' || words[i + 1] for i in range(1, len(words))]) AS pairs FROM worded),
scored AS (
  SELECT doc_id, licence, 2.0::DOUBLE * len(list_intersect(pairs, grams)) / (len(pairs) + len(grams)) AS dice
  FROM paired, templates WHERE len(pairs) BETWEEN len(grams) * {licenses.LEAST} / (2 - {licenses.LEAST}) - 1 AND len(grams) * (2 - {licenses.LEAST}) / {licenses.LEAST} + 1)
SELECT doc_id, licence, max(dice) AS dice, count(*) AS n_passages FROM scored WHERE dice >= {licenses.LEAST} GROUP BY doc_id, licence""")
def op10(spark, sf_dir):
    return licenses.licences(table(spark, sf_dir, "documents"))


def repeated_words(doc_id, text):
    """The words of ``text`` joined by spaces; in a tenth of the documents, picked by doc_id, the words from one of them on repeat the first few of these."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    n = F.size(words)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    cycle = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    again = F.slice(F.flatten(F.array_repeat(cycle, F.ceil((n - a) / p).cast("int"))), F.lit(1), (n - a).cast("int"))
    head = F.when(a > 0, F.slice(words, F.lit(1), a.cast("int"))).otherwise(F.array().cast("array<string>"))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(head, again), " ")).otherwise(text)


@query("op11_periodic_runs")
def op11(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", repeated_words(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic.periodic_runs(docs)
    # Exact order of length / period; ties to the smaller start, then period.
    def before(x, y):
        left, right = x["length"] * y["period"], y["length"] * x["period"]
        return (F.when(left != right, F.when(left > right, -1).otherwise(1)).when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1))
                .otherwise(F.when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0)))

    top = F.get(F.array_sort("runs", before), F.lit(0))
    lines_ = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), top["start"].alias("start"), top["length"].alias("length"), top["period"].alias("period"),
        F.floor(1000 * top["length"] / top["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines_, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@query("op12_html_extraction")
def op12(spark, sf_dir):
    return sitetree.extract(table(spark, sf_dir, "pages"), "op12")


@query("op13_collocations", rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces),
phrases AS (
  SELECT lang, size, unnest([array_to_string(words[i:i + size - 1], ' ') for i in range(1, len(words) - size + 2)]) AS phrase
  FROM worded, (VALUES (1), (2), (3), (4), (5)) sizes(size) WHERE len(words) >= size),
counted AS (SELECT lang, size, phrase, count(*) AS f FROM phrases GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM counted WHERE size = 1 GROUP BY lang),
frequent AS (SELECT * FROM counted WHERE f >= {collocations.LEAST}),
parts AS (SELECT lang, size, phrase, f, string_split(phrase, ' ') AS words FROM frequent WHERE size > 1),
cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(words[1:k], ' ') AS head, array_to_string(words[k + 1:], ' ') AS rest
  FROM parts, (VALUES (1), (2), (3), (4)) cut(k) WHERE k < size),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, k, h.f AS l, t.f AS r, n, 1000::HUGEINT * a * n // (h.f::HUGEINT * t.f) AS score
  FROM cuts JOIN frequent h ON h.lang = cuts.lang AND h.phrase = head JOIN frequent t ON t.lang = cuts.lang AND t.phrase = rest
    JOIN totals ON totals.lang = cuts.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT DISTINCT p.lang, array_to_string(p.words[i:j], ' ') AS phrase, p.f
  FROM parts p, range(1, 5) s(i), range(2, 6) e(j) WHERE j > i AND j <= size AND j - i + 1 < size)
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS INTEGER) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l,
       r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM lowest WHERE NOT EXISTS (SELECT 1 FROM inner_ i WHERE i.lang = lowest.lang AND i.phrase = lowest.phrase AND 100 * i.f >= 100 * lowest.a)
QUALIFY rank <= {collocations.TOP}""")
def op13(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"), name="op13")
