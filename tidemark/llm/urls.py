"""URL filters: a blocked Bloom filter in front of an exact hash join, in DataFrame
functions only.

Listed keys (canonical URLs, and the rules as host and path) set six bits each in one
256-bit block of a filter held as four longs per block. A probe reads one block; what it
passes goes to an exact hash join with the listed keys, which removes the false hits. The
filter is broadcast below ``MAX_BROADCAST_BYTES``, beyond it blocks and probes meet in a
shuffle. Rules are probed once per distinct host and start of path, not once per page, so
a host with a third of all pages costs one probe.

Host and path: see ``parts``. The canonical URL is the host without a leading ``www.`` or
``m.``, and the path without trailing slashes; scheme, query and fragment do not count.

Cases: a url that is null or without ``://`` has empty host and path, fits no rule and is
not listed; repeated pages and null ids are judged row by row; other columns are not read;
an empty table gives no rows; an empty list or an empty set of rules blocks nothing.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.tables import written

MAX_BROADCAST_HITS = 1 << 17  # hosts and starts of paths that a rule fits
MAX_BROADCAST_BYTES = 32 << 20
BLOCK_BITS, BITS_PER_KEY, PROBES = 256, 16, 6
BYTES_PER_BLOCK = 64  # a row of block number and four longs

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(pages: DataFrame) -> DataFrame:
    """``page_id, host, path``: the host is what follows the first ``://`` up to ``/``,
    ``?``, ``#`` or the end, with A-Z lower-cased; the path goes on up to ``?``, ``#`` or
    the end."""
    rest = F.coalesce(F.expr("if(instr(url, '://') > 0, substring(url, instr(url, '://') + 3), '')"), F.lit(""))
    return pages.select("page_id", rest.alias("rest")).select(
        "page_id",
        F.translate(F.regexp_extract("rest", "^[^/?#]*", 0), _UPPER, _LOWER).alias("host"),
        F.regexp_extract("rest", "^[^/?#]*([^?#]*)", 1).alias("path"),
    )


def canonical() -> Column:
    return F.concat(
        F.regexp_replace("host", r"^(www|m)\.", ""), F.regexp_replace("path", "/+$", "")
    )


def of_sites(pages: DataFrame, sites: list[str]) -> DataFrame:
    """The canonical URLs of the pages whose host has one of ``sites`` among its labels."""
    on_site = F.arrays_overlap(F.split("host", "[.]"), F.array(*map(F.lit, sites)))
    return parts(pages).filter(on_site).select(canonical().alias("listed_key")).distinct()


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules as (action, host and path), like ``("block", "example.com/en/")``."""
    rows = [
        F.struct(
            F.lit(rule).alias("rule"),
            F.lit(rule.partition("/")[0]).alias("rule_host"),
            F.lit(rule[len(rule.partition("/")[0]) :]).alias("rule_path"),
            F.lit(action).alias("action"),
        )
        for action, rule in rules
    ]
    empty = "array<struct<rule:string,rule_host:string,rule_path:string,action:string>>"
    return spark.range(1).select(F.inline(F.array(*rows) if rows else F.array().cast(empty)))


def _masks(key: str) -> list[Column]:
    """The bits of a key in its block, as four longs."""
    draw = F.xxhash64(key, F.lit(1))
    masks = []
    for word in range(4):
        mask = F.lit(0).cast("long")
        for probe in range(PROBES):
            place = F.shiftrightunsigned(draw, 8 * probe).bitwiseAND(F.lit(255))
            inside = F.shiftright(place, 6) == word
            bit = F.call_function(
                "shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int")
            )
            mask = mask.bitwiseOR(F.when(inside, bit).otherwise(F.lit(0).cast("long")))
        masks.append(mask)
    return masks


class BloomFilter:
    """A blocked Bloom filter over the column ``listed_key`` of ``keys``."""

    def __init__(self, keys: DataFrame, max_broadcast: int = MAX_BROADCAST_BYTES):
        self.n_blocks = max(1, ceil(keys.count() * BITS_PER_KEY / BLOCK_BITS))
        masks = [m.alias(f"_w{i}") for i, m in enumerate(_masks("listed_key"))]
        blocks = keys.select(self._block("listed_key").alias("_block"), *masks)
        self.blocks = blocks.groupBy("_block").agg(*[F.bit_or(f"_w{i}").alias(f"_w{i}") for i in range(4)])
        self.is_small = self.n_blocks * BYTES_PER_BLOCK <= max_broadcast
        if self.is_small:
            self.blocks = F.broadcast(self.blocks)

    def _block(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.n_blocks))

    def split(self, probes: DataFrame, key: str) -> DataFrame:
        """``probes`` with ``maybe``: false only where ``key`` is certainly not listed."""
        masks = [m.alias(f"_m{i}") for i, m in enumerate(_masks(key))]
        seen = F.lit(True)
        for i in range(4):
            seen = seen & (F.col(f"_w{i}").bitwiseAND(F.col(f"_m{i}")) == F.col(f"_m{i}"))
        return (
            probes.select("*", self._block(key).alias("_block"), *masks)
            .join(self.blocks, "_block", "left")
            .withColumn("maybe", F.coalesce(seen, F.lit(False)))
            .select(*probes.columns, "maybe")
        )


def _by_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, head, rule, action`` of the longest rule, for hosts and starts of paths that
    some rule fits. ``head`` is the path as far as the longest rule path goes. Rule paths
    have few distinct lengths: they are parts of URLs."""
    lengths = sorted(r[0] for r in rules.select(F.length("rule_path")).distinct().collect())
    keyed = rules.withColumn("listed_key", F.concat_ws("\n", "rule_host", "rule_path"))
    # Only ends of hosts with as many labels as some rule has; those are few numbers too.
    dots = F.length("rule_host") - F.length(F.replace("rule_host", F.lit("."), F.lit("")))
    depths = sorted(r[0] + 1 for r in rules.select(dots).distinct().collect())
    labels = F.length("host") - F.length(F.replace("host", F.lit("."), F.lit(""))) + 1
    suffixes = F.array_compact(
        F.array(*[F.when(labels >= d, F.substring_index("host", ".", -d)) for d in depths or [1]])
    )
    heads = urls.select("host", F.substring("path", 1, max(lengths, default=0)).alias("head")).distinct()
    probes = (
        heads.withColumn("_suffix", F.explode(suffixes))
        .withColumn("_length", F.explode(F.array(*map(F.lit, lengths or [0]))))
        .filter(F.length("head") >= F.col("_length"))
        .withColumn("_key", F.concat_ws("\n", "_suffix", F.expr("substring(head, 1, _length)")))
    )
    hits = BloomFilter(keyed.select("listed_key")).split(probes, "_key").filter("maybe")
    exact = hits.join(keyed.hint("shuffle_hash"), F.col("_key") == F.col("listed_key"))
    longest = F.struct(F.length("rule"), F.length("rule_host"))
    return exact.groupBy("host", "head").agg(
        F.max_by("rule", longest).alias("rule"), F.max_by("action", longest).alias("action")
    )


def judge(pages: DataFrame, listed: DataFrame, rules: DataFrame) -> DataFrame:
    """Per row of ``pages``: ``page_id, host, path, rule, verdict, listed``. The longest
    rule decides; without a rule, a listed canonical URL is blocked. ``listed`` has the
    distinct canonical URLs in its column ``listed_key``."""
    listed = written(listed.select("listed_key"), "listed-urls")
    urls = parts(pages).withColumn("canonical", canonical())
    probed = BloomFilter(listed).split(urls, "canonical")
    hits = listed.withColumn("listed", F.lit(True)).hint("shuffle_hash")
    maybe = probed.filter("maybe").join(hits, F.col("canonical") == F.col("listed_key"), "left")
    judged = (
        maybe.withColumn("listed", F.coalesce("listed", F.lit(False)))
        .drop("listed_key")
        .unionByName(probed.filter("not maybe").withColumn("listed", F.lit(False)))
    )
    by_rules = written(_by_rules(urls, rules), "rule-hits")
    if by_rules.count() <= MAX_BROADCAST_HITS:
        by_rules = F.broadcast(by_rules)
    longest = rules.select(F.max(F.length("rule_path"))).first()[0] or 0
    return (
        judged.withColumn("head", F.substring("path", 1, longest))
        .join(by_rules, ["host", "head"], "left")
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.coalesce(
                "action", F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
            ).alias("verdict"),
            "listed",
        )
    )
