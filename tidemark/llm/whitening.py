"""Whitening of embeddings: exact sums, centred covariance, leading components, projection.

Entries become integers ``x = floor(64 c) + 1000000``. One pass sums them exactly, by length
of the vector; a second sums the products of the centred vectors ``(n x - S) / n``, whose
numerator is exact, per dimension pair. That matrix alone, as large as a vector squared, comes
to the driver, where ``eigen`` takes its leading components. They are sent back for the
projection; one more pass measures the covariance of what it gives. Tasks work on blocks of
bounded size and send sums only, which Spark adds by dimension pair.

Cases: vectors that are null or empty or hold a null, NaN, an infinity or an entry of 2^46 or
more are dropped, and so are vectors of another length than most have (of lengths equally
frequent the greatest counts). Equal rows and rows of equal or null ids are vectors of their
own. A component along which nothing varies (its eigenvalue is zero up to rounding) has null
``whitened``; without any variance ``explained`` is zero. ``deviation`` is exact; one beyond
38 digits is null. Without vectors there are no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import arrays, eigen
from tidemark.llm.tables import ship, unused

SCALE, SHIFT = 64, 1_000_000
LIMIT = 2.0**46  # so that 64 c is a whole number of at most 53 bits
BLOCK = 1 << 20  # entries in memory at a time
MAX_DIMENSION = 4096
NOTHING = 1e-12  # a share of the largest eigenvalue

_SUMS = "length int, place int, n long, total decimal(38,0)"
_PAIRS = "a int, b int, total double"


@dataclass(frozen=True)
class Fit:
    n: int
    sums: np.ndarray  # exact, as Python integers if they pass 62 bits
    values: np.ndarray
    components: np.ndarray  # one a row
    trace: float
    mean: np.ndarray  # of the centred vectors as computed
    identity_error: float = float("nan")

    @property
    def varies(self) -> np.ndarray:
        return self.values > NOTHING * max(self.values[0], 0.0)

    @property
    def scaled(self) -> np.ndarray:
        """The projection: unit variance along every component that varies."""
        size = np.sqrt(np.where(self.varies, self.values, 1.0))
        return (self.components / size[:, None]) * self.varies[:, None]


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """``vectors`` with ``column`` as doubles, without rows that have no proper vector."""
    entries = F.col(f"`{column}`").cast("array<double>")
    proper = F.forall(entries, lambda c: c.isNotNull() & (F.abs(c) < LIMIT))
    rows = vectors.filter(entries.isNotNull() & (F.size(entries) > 0) & proper)
    return rows.withColumn(column, entries)


def blocks(values: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """First row and integers of blocks of vectors of one length."""
    width = len(values[0]) if len(values) else 1
    step = max(1, BLOCK // width)
    for at in range(0, len(values), step):
        flat = values.slice(at, step).flatten().to_numpy(zero_copy_only=False)
        yield at, whole(flat).reshape(-1, width)


def whole(entries: np.ndarray) -> np.ndarray:
    return np.floor(entries * SCALE).astype(np.int64) + SHIFT


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n x - S``, exact: 64-bit integers where they suffice, else Python integers."""
    if sums.dtype == object or int(np.abs(x).max(initial=0)) * n + int(np.abs(sums).max()) >= 1 << 62:
        return x.astype(object) * n - sums
    return x * n - sums


def squares(z: np.ndarray) -> pa.Array:
    """Exact sums of squares of the rows."""
    most = int(np.abs(z).max(initial=0))
    if z.dtype != object and most * most * z.shape[1] < 1 << 62:
        return pa.array((z * z).sum(axis=1)).cast(pa.decimal128(38, 0))
    totals = (z.astype(object) ** 2).sum(axis=1).tolist()
    return pa.array(
        [Decimal(t) if t < 10**38 else None for t in totals], pa.decimal128(38, 0)
    )


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, list] = {}

    def sent() -> Iterator[pa.RecordBatch]:
        for length, (n, totals) in found.items():
            columns = [[length] * length, range(length), [n] * length, map(Decimal, totals.tolist())]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0)]
            arrays_ = [pa.array(list(c), kind) for c, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays_, names=["length", "place", "n", "total"])
        found.clear()

    for batch in batches:
        vectors = batch.column(0)
        lengths = np.diff(vectors.offsets.to_numpy())
        for length in np.unique(lengths).tolist():
            same = vectors.filter(pa.array(lengths == length))
            for _, x in blocks(same):
                entry = found.setdefault(length, [0, np.zeros(length, dtype=object)])
                # A block has at most 2^20 entries of at most 53 bits: halves cannot pass 63.
                high, low = x >> 26, x & ((1 << 26) - 1)
                entry[0] += len(x)
                entry[1] += high.sum(axis=0).astype(object) * (1 << 26) + low.sum(axis=0).astype(object)
            if sum(found) > BLOCK:
                yield from sent()
    yield from sent()


def _pairs(total: np.ndarray, means: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The lower triangle, and the sums of the vectors themselves under b = -1."""
    a, b = np.tril_indices(len(total))
    places = np.arange(len(means))
    columns = [
        np.concatenate([a, places]).astype(np.int32),
        np.concatenate([b, np.full(len(means), -1)]).astype(np.int32),
        np.concatenate([total[a, b], means]),
    ]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "total"])
    for at in range(0, len(batch), 1 << 16):
        yield batch.slice(at, 1 << 16)


def _moments(vectors: DataFrame, fit: Fit, projected: bool) -> tuple[np.ndarray, np.ndarray]:
    """Covariance and mean over all vectors: of the centred vectors, or of what the
    projection makes of them, centred by its mean."""
    sent = vectors.sparkSession.sparkContext.broadcast(fit)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = sent.value
        scaled = fit.scaled if projected else None
        size = len(fit.components) if projected else len(fit.sums)
        centre = scaled @ fit.mean if projected else np.zeros(size)
        total, means, seen = np.zeros((size, size)), np.zeros(size), False
        for batch in batches:
            for _, x in blocks(batch.column(0)):
                y = centred(x, fit.n, fit.sums).astype(float) / fit.n
                y = y @ scaled.T - centre if projected else y
                total += y.T @ y
                means += y.sum(axis=0)
                seen = True
        if seen:
            yield from _pairs(total, means)
        arrays.release()

    rows = vectors.mapInArrow(products, _PAIRS).groupBy("a", "b").agg(F.sum("total").alias("total"))
    table = rows.toArrow()  # bounded by the dimension squared
    a, b, total = (table.column(c).to_numpy() for c in ("a", "b", "total"))
    size = int(a.max()) + 1
    matrix, means = np.zeros((size, size)), np.zeros(size)
    pair = b >= 0
    matrix[a[pair], b[pair]] = matrix[b[pair], a[pair]] = total[pair]
    means[a[~pair]] = total[~pair]
    return matrix / fit.n, means / fit.n


def fit(vectors: DataFrame, components: int = 32, column: str = "embedding") -> Fit | None:
    """The whitening of all usable vectors; None without any."""
    ship(vectors.sparkSession)
    rows = usable(vectors.select(F.col(f"`{column}`")), column)
    lengths = rows.mapInArrow(arrays.released(_sums), _SUMS)
    sums = lengths.groupBy("length", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    sums = sums.withColumn("total", F.col("total").cast("decimal(38,0)")).persist()
    try:
        usual = sums.filter("place = 0").orderBy(F.desc("n"), F.desc("length")).first()
        if usual is None:
            return None
        if usual.length > MAX_DIMENSION:
            raise ValueError(f"{column}: {usual.length} entries, more than {MAX_DIMENSION}")
        kept = sums.filter(F.col("length") == usual.length).orderBy("place").collect()
    finally:
        sums.unpersist()
    totals = [int(r.total) for r in kept]
    wide = max(map(abs, totals)) >= 1 << 62
    exact = np.array(totals, dtype=object if wide else np.int64)
    none = np.zeros((0, usual.length))
    start = Fit(usual.n, exact, np.zeros(0), none, 0.0, np.zeros(usual.length))
    same = rows.filter(F.size(column) == usual.length)
    covariance, mean = _moments(same, start, projected=False)
    count = min(components, usual.length)
    values, found = eigen.leading(covariance, count)
    trace = float(np.trace(covariance))
    whitening = Fit(usual.n, exact, values, found, trace, mean)
    white, _ = _moments(same, whitening, projected=True)
    varies = whitening.varies
    error = np.abs(white[varies][:, varies] - np.eye(int(varies.sum()))).max(initial=0.0)
    return Fit(usual.n, exact, values, found, trace, mean, float(error))


def whiten(vectors: DataFrame, fit: Fit | None, column: str = "embedding") -> DataFrame:
    """The usable rows of ``vectors`` with ``deviation``, decimal(38,0), and ``whitened``, an
    array with one entry a component; a column of such a name is replaced."""
    ship(vectors.sparkSession)
    name = unused(vectors, "_white")
    kind = "struct<deviation:decimal(38,0),whitened:array<double>>"
    if fit is None:
        rows = vectors.limit(0).withColumn(name, F.lit(None).cast(kind))
    else:
        sent = vectors.sparkSession.sparkContext.broadcast(fit)

        @F.arrow_udf(kind)
        def white(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            fit = sent.value
            for batch in batches:
                deviations, projected = [], []
                for _, x in blocks(batch):
                    z = centred(x, fit.n, fit.sums)
                    deviations.append(squares(z))
                    y = (z.astype(float) / fit.n) @ fit.scaled.T
                    mask = np.broadcast_to(~fit.varies, y.shape).ravel()
                    ends = np.arange(0, y.size + 1, y.shape[1], dtype=np.int32)
                    projected.append(pa.ListArray.from_arrays(ends, pa.array(y.ravel(), mask=mask)))
                yield pa.StructArray.from_arrays(
                    [
                        pa.concat_arrays(deviations or [pa.array([], pa.decimal128(38, 0))]),
                        pa.concat_arrays(projected or [pa.array([], pa.list_(pa.float64()))]),
                    ],
                    names=["deviation", "whitened"],
                )
            arrays.release()

        entries = F.col(f"`{column}`").cast("array<double>")
        same = usable(vectors, column).filter(F.size(column) == len(fit.sums))
        rows = same.withColumn(name, white(entries))
    return rows.withColumns(
        {"deviation": F.col(name)["deviation"], "whitened": F.col(name)["whitened"]}
    ).drop(name)
