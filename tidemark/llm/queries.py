"""The registered queries of this subpackage: thin, over whole tables, deriving their
columns from what the operators return."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    audit,
    bagminhash,
    bpe,
    exact_dedup,
    langid,
    lbl,
    lines,
    pii,
    shards,
    simple8b,
    tiling,
    urls,
    whitening,
)
from tidemark.llm.tables import table
from tidemark.session import apply_settings, scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MULTI_BPE = "byte_bpe_multi_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(apply_settings(spark), sf_dir)

    QUERIES[build.__name__] = run
    return run


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(MULTI_BPE)
    documents = table(spark, sf_dir, "documents")
    return bpe.encode(documents, ranks, public_tokenizers.PATTERN, decoded=True).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


ORACLES["op2_exact_dedup"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)
"""


@query
def op3_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "simple8b")
    documents = table(spark, sf_dir, "documents")
    simple8b.write(documents, public_tokenizers.path(WORD_BPE), folder, end_id=2)
    return simple8b.read(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


# The rules, and the sites whose URLs are listed.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
LISTED_SITES = ["adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm"]


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    listed = urls.of_sites(pages, LISTED_SITES)
    return urls.judge(pages, listed, urls.rule_table(spark, URL_RULES))


ORACLES["op5_url_filter"] = """
WITH u AS (
    SELECT page_id, row_number() OVER () AS rid,
        CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
p AS (
    SELECT page_id, rid, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
        translate(regexp_extract(rest, '^[^/?#]*'),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
    FROM u),
c AS (
    SELECT *, regexp_replace(host, '^(www|m)[.]', '') || regexp_replace(path, '/+$', '') AS canonical
    FROM p),
listed AS (
    SELECT DISTINCT canonical FROM c WHERE list_has_any(string_split(host, '.'),
        ['adult-x', 'ads-track', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm'])),
r(action, rule, rule_host, rule_path) AS (VALUES
    ('allow', 'com/', 'com', '/'),
    ('block', 'example.com/en/', 'example.com', '/en/'),
    ('allow', 'www.example.com/en/', 'www.example.com', '/en/'),
    ('block', 'net/es/', 'net', '/es/'),
    ('block', 'net/fr/', 'net', '/fr/')),
best AS (
    SELECT rid, rule, action FROM c, r
    WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length(rule) DESC) = 1)
SELECT page_id, host, path, rule, canonical IN (SELECT canonical FROM listed) AS listed,
    coalesce(action, CASE WHEN canonical IN (SELECT canonical FROM listed)
        THEN 'block' ELSE 'allow' END) AS verdict
FROM c LEFT JOIN best USING (rid)
"""


@query
def op6_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.interleave(table(spark, sf_dir, "documents"), shards=16).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


@query
def op7_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bagminhash.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size", "kept")


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    index = lines.LineIndex(spark).insert(documents)
    return index.clean(documents).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


@query
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tiling.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", "coverage", "items")


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = langid.held_out(4)
    model = langid.fit(documents.filter(~held_out))
    return langid.predict(documents, model).withColumn("held_out", held_out)


@query
def op10_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lbl.score(table(spark, sf_dir, "documents"), modulus=7)


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    fit = whitening.fit(vectors, components=32)
    rows = whitening.whiten(vectors, fit)
    values = [] if fit is None else fit.values.tolist()
    trace = 0.0 if fit is None else fit.trace
    shares = F.array(*[F.lit(value / trace if trace else 0.0) for value in values])
    return rows.select(
        F.col("vec_id").cast("long"),
        # Beyond 64 bits there is no such long.
        F.expr("try_cast(deviation AS long)").alias("deviation"),
        F.posexplode("whitened").alias("place", "whitened"),
    ).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(fit.n if fit else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.try_element_at(shares.cast("array<double>"), F.col("place") + 1).alias("explained"),
        F.lit(fit.identity_error if fit else 0.0).alias("identity_error"),
    )


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op12_filter_audit"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (
    SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d),
f AS (
    SELECT doc_id, part,
        [len(words) < 200,
         100 * len(list_distinct(words)) < 50 * len(words),
         100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t),
         regexp_matches(t, '[#$%&*|]'),
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails
    FROM w),
l AS (
    SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
c AS (
    SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
k AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
o AS (
    SELECT [a.i, b.i, c.i, d.i, e.i] AS ids
    FROM k a, k b, k c, k d, k e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT ids, k.i AS step, ids[k.i] AS own, ids[1:k.i - 1] AS before FROM o, k),
g AS (
    SELECT part, array_to_string(list_transform(ids, lambda x: substr('ABCDE', x, 1)), '') AS filter_order,
        step, own, n, good, toxic, fails[own] AS failing,
        len(list_filter(before, lambda x: fails[x])) > 0 AS gone,
        len(list_filter(fails, lambda x: x)) = 1 AS once
    FROM c, s),
r AS (
    SELECT part, filter_order, step, own,
        coalesce(sum(n) FILTER (NOT failing AND NOT gone), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (failing AND NOT gone), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (failing AND gone), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (failing AND once), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (failing AND NOT gone), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (failing AND NOT gone), 0)::BIGINT AS toxic_lost
    FROM g GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r
"""


@query
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        of_kind = F.filter(base, lambda s: s["kind"] == kind)
        return F.size(of_kind).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in ("email", "ip", "card", "phone")],
        F.sha2(pii.joined(base), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
    )
