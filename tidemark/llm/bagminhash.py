"""Near-duplicate classes by BagMinHash signatures over shingles of five words.

A text is a bag of shingles with their counts as weights. The weight axis is cut into
dyadic intervals (0,1], (1,2], (2,4], (4,8] ...; every shingle has one Poisson process per
interval it reaches, whose points carry an arrival time, a register and a level. Points
above the shingle's own weight do not count, and each register keeps its earliest point:
two bags agree in a register with the probability of their weighted Jaccard similarity. A
process stops as soon as its time is beyond the latest register, so most shingles of a
long text cost one point.

Registers are banded; texts that share a band are candidates, and candidates are verified
by the overlap of their bags (sum of smaller counts over sum of larger counts, 0.8 or
more). Texts with equal bags are collapsed first. A band shared by very many texts is not
paired out: its members are compared with a hub (the text that shares most bands), then
with a second hub in another component; where a band still spans several components, what
is outside the first hub's component is compared with all texts of other components, in
blocks that give links and no pairs. That tests every candidate pair whose link could
join two components, so the classes are those of all verified links. Groups of comparisons
are salted by size, and classes are connected components.

Of each class the document with the smallest ``doc_id`` is kept and names the class.

Cases: null counts as empty; a text with one to four words is one shingle of them all; a
text without words is only like the same text; rows with equal id and bag are returned
each and at most one is kept; a null id is the last choice; further columns are not read;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import arrays, shingles
from tidemark.llm.components import components
from tidemark.llm.tables import staying, text_or_empty, texts, written
from tidemark.llm.urls import BloomFilter

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 48, 8
GROUP_LINKS = 200
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SIDE = np.uint64(0x5851F42D4C957F2D)


def bags(some: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text the distinct shingles and their counts: text number, hash, count."""
    words, bounds = shingles.word_hashes(some)
    found, inside = shingles.windows(words, bounds, SHINGLE)
    text = np.repeat(np.arange(len(some)), np.diff(inside))
    sizes = np.diff(bounds)
    for length in range(1, SHINGLE):
        short = np.flatnonzero(sizes == length)
        if len(short):
            hashes, at = shingles.windows(words, bounds, length)
            found = np.concatenate([found, arrays.mix(hashes[at[short]] + np.uint64(length))])
            text = np.concatenate([text, short])
    if not len(found):
        return text, found, np.empty(0, dtype=np.int64)
    order = np.lexsort((found, text))
    text, found = text[order], found[order]
    new = np.concatenate([[True], (np.diff(text) != 0) | (found[1:] != found[:-1])])
    first = np.flatnonzero(new)
    return text[first], found[first], np.diff(np.append(first, len(found)))


def _processes(text, found, count):
    """One Poisson process per shingle and dyadic interval it reaches: text, seed, width
    and lower end of the interval, weight."""
    parts, k = [], 0
    reach = np.ones(len(count), dtype=bool)
    while reach.any():
        low, width = (0, 1) if k == 0 else (1 << (k - 1), 1 << (k - 1))
        seed = arrays.mix(found[reach] ^ arrays.mix(np.array([k + 1], dtype=np.uint64)))
        size = int(reach.sum())
        parts.append(
            (text[reach], seed, np.full(size, width), np.full(size, low), count[reach])
        )
        reach = count > low + width
        k += 1
    return [np.concatenate(p) for p in zip(*parts)]


def registers(text, found, count, n_texts: int, m: int) -> np.ndarray:
    """The earliest arrival per text and register; infinity for texts without shingles."""
    out = np.full((n_texts, m), np.inf)
    if not len(text):
        return out
    text, seed, width, low, count = _processes(text, found, count)
    total = np.bincount(text, weights=np.minimum(count - low, width), minlength=n_texts)
    has = total > 0
    # All registers have a point before this time but for one text in a hundred or so.
    limit = np.where(has, (log(m) + 5) / np.maximum(total, 1), 0.0)
    pending = has
    while pending.any():
        _run(out, *(a[pending[text]] for a in (text, seed, width, low, count)), limit, m)
        pending = has & np.isinf(out).any(axis=1)
        limit = np.where(pending, 2 * limit, limit)
    return out


def _run(out, text, seed, width, low, count, limit, m) -> None:
    """Run processes until their time is beyond ``limit`` or the text's latest register."""
    flat = out.reshape(-1)
    time = np.zeros(len(text))
    step = np.zeros(len(text), dtype=np.uint64)
    rate = width * float(m)
    bound = limit.copy()
    while len(text):
        expected = rate * (bound[text] - time) / 2
        block = np.exp2(np.clip(np.ceil(np.log2(np.maximum(expected, 1e-9))), 0, 6)).astype(int)
        for size in np.unique(block):
            mine = np.flatnonzero(block == size)
            steps = step[mine][:, None] + np.arange(1, size + 1, dtype=np.uint64)
            draw = arrays.mix(seed[mine][:, None] + steps * _STEP)
            gap = -np.log(((draw >> np.uint64(11)) + np.uint64(1)) * 2.0**-53) / rate[mine][:, None]
            # Summed one after the other, so a time is the same bits in every text.
            times = np.add.accumulate(np.concatenate([time[mine][:, None], gap], axis=1), axis=1)[:, 1:]
            mark = arrays.mix(draw ^ _SIDE)
            register = ((mark >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
            level = (mark & np.uint64(0xFFFFFFFF)) * 2.0**-32 * width[mine][:, None]
            counts = level + low[mine][:, None] < count[mine][:, None]
            counts &= times <= bound[text[mine]][:, None]
            place = text[mine][:, None] * m + register.astype(np.int64)
            np.minimum.at(flat, place[counts], times[counts])
            time[mine] = times[:, -1]
            step[mine] += np.uint64(size)
        bound = np.minimum(limit, out.max(axis=1))
        alive = time < bound[text]
        text, seed, width, low, count = (a[alive] for a in (text, seed, width, low, count))
        time, step, rate = time[alive], step[alive], rate[alive]


def band_keys(values: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    parts = values.view(np.uint64).reshape(len(values), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for row in range(rows):
        key = arrays.mix(key * _STEP + parts[:, :, row])
    return key.view(np.int64)


def _digests(some: list[str], text, found, count) -> list[bytes]:
    """Sixteen bytes per text, equal for equal bags; without shingles, for equal texts."""
    out = np.zeros((len(some), 2), dtype=np.uint64)
    weight = count.astype(np.uint64)
    for side, salt in enumerate((_STEP, _SIDE)):
        np.add.at(out[:, side], text, arrays.mix(found ^ salt) * weight)
    empty = np.setdiff1d(np.arange(len(some)), text)
    for place in empty.tolist():
        data = np.frombuffer(b"\0" + some[place].encode(), dtype=np.uint8)
        whole = arrays.run_hashes(data, np.array([0]), np.array([len(data)]))
        out[place] = arrays.mix(whole)[0], arrays.mix(whole ^ _SIDE)[0]
    return [row.tobytes() for row in out]


def signatures(documents: DataFrame) -> DataFrame:
    """Per row ``doc_id, tie`` (a hash of the text), ``digest`` and the ``bands``, none for
    a text without words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.column("text").to_pylist()
            # A short text takes as many points as a long one: bound the texts as well.
            for first, group in shingles.groups(some, 1 << 19, 200):
                bag = bags(group)
                values = registers(*bag, len(group), BANDS * ROWS)
                has = np.isfinite(values[:, 0])
                bands = [keys if ok else [] for keys, ok in zip(band_keys(values), has)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(group)),
                        batch.column("tie").slice(first, len(group)),
                        pa.array(_digests(group, *bag), pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "tie", "digest", "bands"],
                )

    ready = texts(documents).select("doc_id", F.xxhash64("text").alias("tie"), "text")
    return ready.mapInArrow(arrays.released(rows), "doc_id long, tie long, digest binary, bands array<long>")


def similarities(hub: str, members: list[str]) -> list[float]:
    """Weighted Jaccard similarity of each member's bag with the hub's."""
    _, keys, held = bags([hub])
    out = []
    for _, group in shingles.groups(members):
        text, found, count = bags(group)
        at = np.searchsorted(keys, found)
        at[at == len(keys)] = 0
        shared = np.where(keys[at] == found, np.minimum(count, held[at]), 0) if len(keys) else 0 * count
        both = np.bincount(text, weights=shared, minlength=len(group))
        either = np.bincount(text, weights=count, minlength=len(group)) + held.sum() - both
        out += (both / np.maximum(either, 1)).tolist()
    return out


def fetch_texts(documents: DataFrame, nodes: DataFrame, needed: DataFrame) -> DataFrame:
    """``node, text`` of the ``needed`` nodes. A Bloom filter of their text hashes keeps the
    other texts from being shuffled for the join; without room for it all are."""
    held = nodes.join(needed, "node").select("node", F.col("doc_id").alias("_id"), "tie")
    held = written(held, "needed-nodes")
    ready = texts(documents).select("doc_id", F.xxhash64("text").alias("_tie"), "text")
    wanted = BloomFilter(held.select(F.col("tie").alias("listed_key")))
    if wanted.is_small:
        ready = wanted.split(ready, "_tie").filter("maybe")
    same = (F.col("tie") == F.col("_tie")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    found = ready.join(held, same).select("node", "text")
    # Rows repeated with the same id and text have one text.
    return written(found.dropDuplicates(["node"]), "needed-texts")


LINKS = "low long, high long"


def _links(low: list[int], high: list[int]) -> pa.Table:
    return pa.table({"low": pa.array(low, pa.int64()), "high": pa.array(high, pa.int64())})


def verified(links: DataFrame, held: DataFrame, least: float) -> DataFrame:
    """The ``links`` (hub, member) with a similarity of at least ``least``. ``held`` has the
    texts; a hub's text goes to every salt of its links."""
    sizes = links.groupBy("hub").agg(F.count("*").alias("n"))
    salts = F.ceil(F.col("n") / F.lit(GROUP_LINKS)).cast("long")
    salted = links.join(written(sizes, "hub-sizes"), "hub").select(
        "hub", "member", F.pmod(F.xxhash64("member", "hub"), salts).alias("salt")
    )
    salted = written(salted, "salted-links")
    members = salted.join(held, salted["member"] == held["node"])
    hubs = salted.select("hub", "salt").distinct().join(held, F.col("hub") == F.col("node"))
    members = members.select("hub", "salt", "member", "text")
    hubs = hubs.select("hub", "salt", F.lit(None).cast("long").alias("member"), "text")

    def compare(rows: pa.Table) -> pa.Table:
        ids, some = rows.column("member").to_pylist(), rows.column("text").to_pylist()
        hub = some[ids.index(None)]
        pairs = [(i, t) for i, t in zip(ids, some) if i is not None]
        found = similarities(hub, [t for _, t in pairs])
        good = [i for (i, _), s in zip(pairs, found) if s >= least - 1e-12]
        return _links([rows.column("hub")[0].as_py()] * len(good), good)

    found = members.unionByName(hubs).groupBy("hub", "salt").applyInArrow(compare, LINKS)
    return written(found, "verified-links")


def _elements(some: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bags as sets: the second copy of a shingle is an element of its own. Text number
    and hash of every element, and the elements of each text."""
    text, found, count = bags(some)
    copy = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    element = arrays.mix(np.repeat(found, count) + copy.astype(np.uint64) * _STEP)
    text = np.repeat(text, count)
    return text, element, np.bincount(text, minlength=len(some))


def all_similarities(some: list[str], others: list[str], columns: int = 1 << 15) -> np.ndarray:
    """Similarities of all ``some`` with all ``others``, by products of membership
    matrices over the elements both sides have, some columns at a time."""
    rows, left, size = _elements(some)
    cols, right, width = _elements(others)
    shared = np.intersect1d(left, right)
    rows, left = rows[np.isin(left, shared)], np.searchsorted(shared, left[np.isin(left, shared)])
    cols, right = cols[np.isin(right, shared)], np.searchsorted(shared, right[np.isin(right, shared)])
    both = np.zeros((len(some), len(others)), dtype=np.float32)
    columns = max(1, min(columns, len(shared)))
    for at in range(0, len(shared), columns):
        a = np.zeros((len(some), columns), dtype=np.float32)
        b = np.zeros((len(others), columns), dtype=np.float32)
        mine, theirs = (left // columns) == at // columns, (right // columns) == at // columns
        a[rows[mine], left[mine] - at] = 1
        b[cols[theirs], right[theirs] - at] = 1
        both += a @ b.T
    return both / np.maximum(size[:, None] + width[None, :] - both, 1)


def verified_in_blocks(outside: DataFrame, split: DataFrame, held: DataFrame, least: float) -> DataFrame:
    """Links between the texts ``outside`` the main component of their band and all texts
    of the band that are in other components. Both are cut into blocks of GROUP_LINKS
    texts, every block of the one meets every block of the other in a task of its own, and
    only links come out."""
    sizes = split.groupBy("band").agg(F.count("*").alias("n"))
    sizes = sizes.join(outside.groupBy("band").agg(F.count("*").alias("m")), "band").select(
        "band",
        F.ceil(F.col("n") / F.lit(GROUP_LINKS)).cast("long").alias("n"),
        F.ceil(F.col("m") / F.lit(GROUP_LINKS)).cast("long").alias("m"),
    )
    sizes = written(sizes, "band-blocks")

    def blocks(rows: DataFrame, own: str, other: str, side: int) -> DataFrame:
        place = F.pmod(F.xxhash64("node", F.lit(side)), F.col(own))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))
        return rows.join(sizes, "band").select(
            "band", "node", "root", place.alias(own), every.alias(other), F.lit(side).alias("side")
        ).select("band", "n", "m", "node", "root", "side")

    placed = blocks(split, "n", "m", 0).unionByName(blocks(outside, "m", "n", 1))
    placed = written(placed, "blocks").join(held, "node")

    def compare(rows: pa.Table) -> pa.Table:
        held = rows.select(["node", "root", "side", "text"]).to_pylist()
        inner, outer = ([r for r in held if r["side"] == side] for side in (0, 1))
        if not inner or not outer:
            return _links([], [])
        like = all_similarities([r["text"] for r in outer], [r["text"] for r in inner])
        found = [
            (outer[i]["node"], inner[j]["node"])
            for i, j in zip(*np.nonzero(like >= least - 1e-6))
            if outer[i]["root"] != inner[j]["root"]
        ]
        return _links([a for a, _ in found], [b for _, b in found])

    return written(placed.groupBy("band", "n", "m").applyInArrow(compare, LINKS), "verified-blocks")


def classes(documents: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Per row of ``documents``: ``doc_id, class_id, class_size, kept``, with ``tie``, a hash
    of the text, and ``repeats``, the number of rows with the same id and text."""
    signed = written(signatures(documents), "signatures")
    nodes = signed.groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")).alias("first"),
        F.first("bands").alias("bands"),
    )
    nodes = nodes.select("digest", "first.doc_id", "first.tie", "bands")
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    roots = _roots(documents, nodes, least)

    # Each distinct bag with its class, and the document that stands for the class.
    named = (
        nodes.select("digest", "node", "doc_id")
        .join(roots, "node", "left")
        .select("digest", "doc_id", F.coalesce("root", "node").alias("root"))
    )
    # Rows repeated with one id and text are one link with a count.
    rows = signed.groupBy("doc_id", "digest", "tie").agg(F.count("*").alias("m"))
    rows = rows.join(written(named.select("digest", "root"), "bag-classes"), "digest")
    rows = written(rows, "class-rows")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest", "tie")
    heads = rows.groupBy("root").agg(F.min(rank).alias("head"), F.sum("m").alias("class_size"))
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))).alias("copy")
    stays = (
        F.col("doc_id").eqNullSafe(F.col("head.doc_id"))
        & (F.col("digest") == F.col("head.digest"))
        & (F.col("tie") == F.col("head.tie"))
        & (F.col("copy") == 1)
    )
    return (
        rows.join(written(heads, "class-heads"), "root")
        .select("*", copy)
        .select(
            "doc_id",
            F.col("head.doc_id").alias("class_id"),
            "class_size",
            stays.alias("kept"),
            "tie",
            F.col("m").alias("repeats"),
        )
    )


def keep(documents: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of ``documents`` that stay, one per class, with all their columns."""
    return staying(documents, classes(documents, least), F.xxhash64(text_or_empty()), "tie")


def _roots(documents: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """``node, root`` of the nodes that have a verified link."""
    banded = nodes.select("node", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    members = written(banded.join(written(shared, "shared-bands"), "band"), "band-members")
    weights = members.groupBy("node").agg(F.sum("n").alias("weight"))
    weights = written(weights, "node-weights")
    members = members.join(weights, "node").select("band", "node", "weight")
    members = written(members, "weighted-members")
    held = fetch_texts(documents, nodes, weights.select("node"))

    def star(rows: DataFrame, hubs: DataFrame) -> DataFrame:
        """Links of ``rows`` with the hub of their band."""
        links = rows.join(written(hubs, "band-hubs"), "band").filter("node != hub")
        return links.select("hub", F.col("node").alias("member")).distinct()

    def split_bands(links: DataFrame) -> DataFrame:
        """Members of the bands that still span several components, with their root."""
        rows = members.join(components(links), "node", "left")
        rows = written(rows.withColumn("root", F.coalesce("root", "node")), "placed-members")
        ends = rows.groupBy("band").agg(F.min("root").alias("a"), F.max("root").alias("b"))
        spread = written(ends.filter("a < b").select("band"), "split-bands")
        return written(rows.join(spread, "band"), "split-members")

    def outside_first(split: DataFrame) -> DataFrame:
        """What is not in the component of the band's hub."""
        first = split.groupBy("band").agg(F.max(F.struct("weight", "node", "root")).alias("f"))
        rest = split.join(written(first, "first-hubs"), "band").filter("root != f.root")
        return written(rest.drop("f"), "outside")

    first = members.groupBy("band").agg(F.max(F.struct("weight", "node")).getField("node").alias("hub"))
    links = verified(written(star(members, first), "links-1"), held, least)
    split = split_bands(links)
    if split.limit(1).count():
        # A second hub, of another component than the first, with all the other components.
        second = outside_first(split).groupBy("band").agg(
            F.max(F.struct("weight", "node", "root")).alias("s")
        )
        more = star(split, second.select("band", F.col("s.node").alias("hub")))
        links = written(links.unionByName(verified(written(more, "links-2"), held, least)), "links-2")
        split = split_bands(links)
    if split.limit(1).count():
        # What is outside the first hub's component, with all of other components.
        outside = outside_first(split)
        found = verified_in_blocks(outside, split, held, least)
        links = written(links.unionByName(found), "links-3")
    return components(links)
