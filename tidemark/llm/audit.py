"""What quality filters remove, in every order: one pass over the texts, then counts.

Each row fails some of five filters: A under 200 words, B fewer distinct words than half,
C more than 3 % of its code points in A-Z, D any of ``#$%&*|``, E its text stands in a row
of smaller ``doc_id``. A to D come from the row alone. E is an existential self-join: a
left-semi join on hash, exact text and smaller ``doc_id``. Its right side has each repeated
text once, with its smallest id (an id smaller than that of a row exists if the smallest is
smaller), reduced before the shuffle; and only texts whose hash repeats take part. A text
with very many rows is salted: its rows are dealt to several keys, the one row of the right
side is repeated for each.

The ids marked by E are united with those of the other filters, and the bits of a row are
combined. From then on the audit is about the at most 32 combinations of a part: what a
filter removes depends on the set of filters before it, not on their order, so 80 pairs of
(set before, filter) answer all 120 orders.

Cases: a null text counts as empty, a null language is the part "". A null ``doc_id`` is
neither smaller nor greater than any. Rows of equal id and text do not make each other fail
E; every row counts. A document with several labels is good or toxic if any of them says so.
Other columns are not read. An empty table has no parts and gives no rows.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import text_or_empty, written

FILTERS = "ABCDE"
WORD = r"[^\x20\x09-\x0D]+"
MAX_BROADCAST_ROWS = 1 << 20  # hashes and counts, 16 MB
ROWS_PER_SALT = 500


def own_failures(text: Column) -> Column:
    """The bits of filters A to D, from the text alone."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, points = F.size(words), F.length(text)
    capitals = points - F.length(F.regexp_replace(text, "[A-Z]", ""))
    fails = (
        n < 200,
        F.size(F.array_distinct(words)) * 100 < n * 50,
        capitals.cast("long") * 100 > points.cast("long") * 3,
        text.rlike("[#$%&*|]"),
    )
    bits = [F.when(fail, 1 << k).otherwise(0) for k, fail in enumerate(fails)]
    return sum(bits[1:], bits[0])


def _rows(documents: DataFrame) -> DataFrame:
    """What the audit reads. Two hashes tell apart rows that share an id."""
    text = text_or_empty()
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.xxhash64(text).alias("code"),
        F.hash(text).alias("code2"),
        text.alias("text"),
    )


def with_earlier_copy(
    rows: DataFrame, max_broadcast: int = MAX_BROADCAST_ROWS, per_salt: int = ROWS_PER_SALT
) -> DataFrame:
    """The rows whose text stands in a row of smaller ``doc_id``, without the text."""
    repeated = written(
        rows.groupBy("code").agg(F.count("*").alias("n")).filter("n > 1"), "repeated"
    )
    salts = F.ceil(F.col("n") / per_salt).cast("int")
    if repeated.count() <= max_broadcast:
        repeated = F.broadcast(repeated)
    rows = rows.join(repeated, "code")
    salt = F.pmod(F.xxhash64("doc_id", "part"), salts).cast("int")
    left = rows.withColumn("salt", salt)
    right = (
        rows.groupBy("code", "text")
        .agg(F.min("doc_id").alias("least"), F.max("n").alias("n"))
        .select("code", "text", "least", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    )
    earlier = (
        (F.col("l.code") == F.col("r.code"))
        & (F.col("l.salt") == F.col("r.salt"))
        & (F.col("l.text") == F.col("r.text"))
        & (F.col("r.least") < F.col("l.doc_id"))
    )
    found = left.alias("l").join(right.alias("r"), earlier, "left_semi")
    return found.select("doc_id", "part", "code", "code2")


def failures(documents: DataFrame) -> DataFrame:
    """``doc_id, part, bits, n``: the filters that rows fail (A is 1, E is 16), and how
    many equal rows there are. Rows that differ in text have entries of their own."""
    rows = _rows(documents)
    names = ("doc_id", "part", "code", "code2")
    alone = rows.select(*names, own_failures(F.col("text")).alias("bits"), F.lit(1).alias("n"))
    copies = with_earlier_copy(rows).select(*names, F.lit(16).alias("bits"), F.lit(0).alias("n"))
    united = alone.unionByName(copies).groupBy(*names)
    both = united.agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    return both.select("doc_id", "part", "bits", "n")


def combinations(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows, good rows and toxic rows by part and combination of failures."""
    labelled = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )

    def rows(which: Column) -> Column:
        return F.sum(F.when(which, F.col("n")).otherwise(0))

    return (
        failed.join(labelled, "doc_id", "left")
        .groupBy("part", "bits")
        .agg(F.sum("n").alias("n"), rows(F.col("good")).alias("good"), rows(F.col("toxic")).alias("toxic"))
    )


def _pairs() -> Column:
    """Every filter with every set of filters that may come before it."""
    sets = range(1 << len(FILTERS))
    pairs = [(before, 1 << k) for k in range(len(FILTERS)) for before in sets if not before >> k & 1]
    return F.array(
        *[F.struct(F.lit(before).alias("before"), F.lit(own).alias("own")) for before, own in pairs]
    )


def _orders(spark) -> DataFrame:
    rows = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            own = 1 << FILTERS.index(letter)
            rows.append(("".join(order), step, before, own))
            before |= own
    return spark.createDataFrame(rows, "filter_order string, step int, before int, own int")


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order of the filters and step: ``kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley``. ``shapley`` sums what the step's filter removes over
    all orders; a 120th of it is the filter's Shapley value."""
    found = written(combinations(failures(documents), labels), "combinations")
    pairs = found.select("*", F.explode(_pairs()).alias("pair")).select("*", "pair.*")
    fails, gone = (F.col("bits").bitwiseAND(F.col(c)) != 0 for c in ("own", "before"))

    def count(which: Column, of: str = "n") -> Column:
        return F.sum(F.when(which, F.col(of)).otherwise(F.lit(0).cast("long")))

    pairs = pairs.groupBy("part", "before", "own").agg(
        count(~fails & ~gone).alias("kept"),
        count(fails & ~gone).alias("removed"),
        count(fails & gone).alias("redundant"),
        count(F.col("bits") == F.col("own")).alias("unique_fails"),
        count(fails & ~gone, "good").alias("good_lost"),
        count(fails & ~gone, "toxic").alias("toxic_lost"),
    )
    # So many orders have exactly this set before this filter.
    last = len(FILTERS) - 1
    orders = F.element_at(
        F.array(*[F.lit(factorial(k) * factorial(last - k)) for k in range(last + 1)]),
        F.bit_count("before") + 1,
    )
    shares = pairs.groupBy("part", "own").agg(F.sum(F.col("removed") * orders).alias("shapley"))
    steps = F.broadcast(_orders(documents.sparkSession))
    return (
        pairs.join(shares, ["part", "own"])
        .join(steps, ["before", "own"])
        .select(
            "part", "filter_order", "step", "kept", "removed", "redundant",
            "unique_fails", "good_lost", "toxic_lost", "shapley",
        )
    )
