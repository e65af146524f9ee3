"""Language identification by error-correcting output codes.

Every language has a codeword; each bit of the words splits the languages in two, and a
linear classifier over byte n-grams predicts it: the log ratio of the n-gram's rate in the
languages with the bit to its rate in those without, averaged over the text and fitted to
a probability by a one-dimensional logistic regression. Decoding adds up, per language,
the logistic losses of the predicted bits against its codeword, each bit weighted by how
well it did in training, and takes the nearest codeword. The score is the share of that
codeword among all (softmax of the losses); below ``CERTAIN`` the text is ``ambiguous``.

``reject`` drops texts in no learned language: those too far from every codeword, those with
too many n-grams that no training text has, and those with too few n-grams with a letter. The
distance is the mean loss of a bit; where a text says nothing about any bit it is log 2. All
limits come from the sample, each text of which is held against the others, its own n-grams
taken out of the weights; texts of fewer than ``LEAST`` n-grams are too short to tell and stay.
If nothing could be learned it drops only texts without letters. Where training texts
themselves share few n-grams, nothing is dropped so.

Training takes at most ``SAMPLE_PER_LANGUAGE`` rows of each language, drawn by a hash of
text and id, whole texts each. N-gram counts are aggregated by Spark; what comes to the
driver is bounded by languages times ``BUCKETS``, and by the rows of the sample. The model
sent to the tasks has ``BUCKETS`` times the length of a codeword numbers.

Cases: a null text, or one without letters, is ``und`` with score 0; so is every text if
nothing could be learned; with one language learned it is always that one, with score 1.
Rows without a language are not learned from; repeated rows are judged each; further
columns are kept by ``reject`` and not read by ``predict``; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import arrays, shingles
from tidemark.llm.tables import ship, text_or_empty, written

SAMPLE_PER_LANGUAGE = 1500
PAIRS, TRIPLES = 1 << 16, 1 << 16
BUCKETS = PAIRS + TRIPLES
CERTAIN = 0.6
UNKNOWN = "und"
LEAST, STRANGE, FAR = 48, 0.1, 0.5
_LETTERS = np.full(256, 32, dtype=np.uint8)
_LETTERS[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTERS[128:] = np.arange(128, 256)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all byte pairs and triples of the lower-cased letters of each text, and
    the bounds of each text among them. What is no letter is a blank."""
    parts = [b"  " + t.lower().encode() + b" " for t in texts]
    data = _LETTERS[np.frombuffer(b"".join(parts), dtype=np.uint8)].astype(np.uint32)
    bounds = np.cumsum([0, *map(len, parts)])
    pairs = (data[:-2] << 8) | data[1:-1]
    triples = ((pairs << np.uint32(8)) | data[2:]) * np.uint32(0x9E3779B1)
    out = np.empty((len(pairs), 2), dtype=np.int64)
    out[:, 0] = pairs
    out[:, 1] = PAIRS + (triples >> np.uint32(16))
    # The last windows of a text reach into the next: they are left out.
    inside = np.ones(len(data), dtype=bool)
    inside[bounds[1:] - 1] = inside[bounds[1:] - 2] = False
    sizes = 2 * (np.diff(bounds) - 2)
    return out[inside[:-2]].reshape(-1), np.concatenate([[0], np.cumsum(sizes)])


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """A row of +1 and -1 per language. Up to four languages: all ways to split them. More:
    the draw with the largest distance between the nearest words."""
    if n <= 4:
        return np.array(
            [[1 if (bit >> row) & 1 else -1 for bit in range(1, 2 ** (n - 1))] for row in range(n)]
        ).reshape(n, -1)
    bits, rng = max(15, int(np.ceil(10 * np.log2(n)))), np.random.default_rng(seed)
    best, best_distance = None, -1
    for _ in range(200):
        words = rng.choice([-1, 1], size=(n, bits))
        if (np.abs(words.sum(axis=0)) == n).any():
            continue
        apart = (bits - words @ words.T) // 2
        distance = int(apart[~np.eye(n, dtype=bool)].min())
        if distance > best_distance:
            best, best_distance = words, distance
    return best


_BLANKS = np.zeros(BUCKETS, dtype=bool)
_BLANKS[np.unique(grams([" "])[0])] = True


@dataclass
class Model:
    languages: list[str]
    words: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits
    scale: np.ndarray
    shift: np.ndarray
    trust: np.ndarray
    seen: np.ndarray | None = None  # count of every bucket in all training texts
    most_unseen: float = 1.0
    least_lettered: float = 0.0
    farthest: float = np.inf

    def margins(self, texts: list[str]) -> np.ndarray:
        """The mean log ratio of each bit over a text."""
        found, bounds = grams(texts)
        sums = np.add.reduceat(self.weights[found], bounds[:-1], axis=0)
        return sums / np.diff(bounds)[:, None]

    def familiarity(self, texts: list[str], own: bool = False) -> np.ndarray:
        """Per text: its n-grams, the share of them with a letter, and the share of these not
        seen in training. ``own`` texts are training texts, held against the others."""
        found, bounds = grams(texts)
        others = self.seen[found]
        if own:
            for a, b in zip(bounds[:-1], bounds[1:]):
                _, places, n = np.unique(found[a:b], return_inverse=True, return_counts=True)
                others[a:b] -= n[places]
        lettered = ~_BLANKS[found]
        n = np.add.reduceat(lettered, bounds[:-1], dtype=np.int64)
        unseen = np.add.reduceat(lettered & (others <= 0), bounds[:-1], dtype=np.int64)
        sizes = np.diff(bounds)
        return np.stack([sizes, n / sizes, unseen / np.maximum(n, 1)], axis=1)

    def strange(self, texts: list[str]) -> np.ndarray:
        """Whether a text is in no learned language."""
        size, lettered, unseen = self.familiarity(texts).T
        odd = (unseen > self.most_unseen) | (lettered < self.least_lettered)
        if np.isfinite(self.farthest):
            odd |= self.distance(self.margins(texts)) > self.farthest
        return (size >= LEAST) & odd

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """The weighted loss of every text against every codeword."""
        bits = margins * self.scale + self.shift
        return np.logaddexp(0, -bits[:, None, :] * self.words[None]) @ self.trust

    def distance(self, margins: np.ndarray) -> np.ndarray:
        """The mean loss of a bit against the nearest codeword."""
        return self.losses(margins).min(axis=1) / self.words.shape[1]

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest codeword and its score."""
        loss = self.losses(margins)
        share = np.exp(loss.min(axis=1, keepdims=True) - loss)
        return loss.argmin(axis=1), share.max(axis=1) / share.sum(axis=1)


def letters() -> Column:
    return text_or_empty().rlike(r"\p{L}")


def _sample(labelled: DataFrame, per_language: int) -> DataFrame:
    """At most ``per_language`` texts of each language: ``lang, text``. Draws are chosen
    without their texts, which are fetched for the chosen ones; repeated rows are one."""
    draw = F.xxhash64("doc_id", text_or_empty(), F.lit(11)).alias("draw")
    rows = labelled.select(
        F.col("lang").cast("string").alias("lang"), text_or_empty().alias("text"), draw
    ).filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    draws = written(rows.select("lang", "draw").distinct(), "language-draws")
    # Written, so that the join knows how small they are and no language is one task.
    counts = written(draws.groupBy("lang").agg(F.count("*").alias("n")), "language-counts")
    share = F.shiftrightunsigned("draw", 11).cast("double") / F.lit(float(1 << 53))
    # A little more than wanted by a threshold on the draw, then exactly the smallest; so
    # only a bounded number of rows is ever ordered.
    some = draws.join(counts, "lang").filter(share * F.col("n") < 1.2 * per_language + 50)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(share, "draw"))
    chosen = some.withColumn("place", place).filter(F.col("place") <= per_language)
    chosen = written(chosen.select("lang", "draw"), "language-sample")
    found = rows.join(chosen, ["lang", "draw"]).dropDuplicates(["lang", "draw"])
    return written(found.select("lang", "text"), "language-texts")


def _counts(sample: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and the count of every bucket in each."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for first, group in shingles.groups(batch.column("text").to_pylist()):
                found, bounds = grams(group)
                for k, lang in enumerate(langs[first : first + len(group)]):
                    mine = held.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                    mine += np.bincount(found[bounds[k] : bounds[k + 1]], minlength=BUCKETS)
        for lang, mine in held.items():
            used = np.flatnonzero(mine)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used)), pa.array(used, pa.int32()), pa.array(mine[used])],
                names=["lang", "bucket", "n"],
            )

    found = sample.mapInArrow(arrays.released(rows), "lang string, bucket int, n long")
    table = found.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(table.column("lang").to_pylist()))
    out = np.zeros((len(languages), BUCKETS))
    row = np.searchsorted(languages, table.column("lang").to_pylist())
    out[row, table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return languages, out


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift with the least logistic loss of ``y`` (+1, -1), slightly damped."""
    spread = x.std() or 1.0
    design = np.stack([x / spread, np.ones(len(x))], axis=1)
    beta = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-design @ beta))
        slope = design.T @ (p - (y > 0)) + 0.1 * beta
        bend = (design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        beta -= np.linalg.solve(bend, slope)
    return beta[0] / spread, beta[1]


def fit(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """A model of the rows with a ``lang``."""
    ship(labelled.sparkSession)
    sample = _sample(labelled, per_language)
    languages, counts = _counts(sample)
    words = codewords(max(1, len(languages)))
    bits = words.shape[1]
    weights = np.zeros((BUCKETS, bits), dtype=np.float32)
    if len(languages) > 1:
        weights[:] = _weights(counts, _totals(counts), words, np.arange(BUCKETS))
    model = Model(languages, words, weights, np.ones(bits), np.zeros(bits), np.ones(bits))
    if len(languages) > 1:
        _calibrate(model, sample)
    if languages:
        model.seen = counts.sum(axis=0).astype(np.int64)
        _set_limits(model, counts, sample)
    return model


def _totals(counts: np.ndarray) -> np.ndarray:
    """N-grams of every language: pairs, triples."""
    return np.stack([counts[:, :PAIRS].sum(axis=1), counts[:, PAIRS:].sum(axis=1)], axis=1)


def _weights(
    counts: np.ndarray, totals: np.ndarray, words: np.ndarray, buckets: np.ndarray
) -> np.ndarray:
    """The log ratio of every bit for ``buckets``, given their counts in each language."""
    part = (buckets >= PAIRS).astype(np.int64)
    rates = (counts + 0.5) / (totals + 0.5 * np.array([PAIRS, TRIPLES]))[:, part]
    out = np.empty((len(buckets), words.shape[1]))
    for bit in range(words.shape[1]):
        with_bit = words[:, bit] > 0
        out[:, bit] = np.log(rates[with_bit].mean(axis=0) / rates[~with_bit].mean(axis=0))
    out[_BLANKS[buckets]] = 0  # blanks alone say nothing
    return out


def _own_margins(
    model: Model, counts: np.ndarray, totals: np.ndarray, lang: str, text: str
) -> np.ndarray:
    """The margins of a training text by the counts of the others."""
    found, _ = grams([text])
    buckets, n = np.unique(found, return_counts=True)
    row = model.languages.index(lang)
    others, left = counts[:, buckets], totals.copy()
    others[row] -= n
    left[row] -= [n[buckets < PAIRS].sum(), n[buckets >= PAIRS].sum()]
    return n @ _weights(others, left, model.words, buckets) / len(found)


def _set_limits(model: Model, counts: np.ndarray, sample: DataFrame) -> None:
    """Limits well beyond the sample: twice the unseen share, half the share with a letter and
    twice the distance that all but a hundredth of the texts of every language keep."""
    sent = sample.sparkSession.sparkContext.broadcast((model, counts, _totals(counts)))

    @F.arrow_udf("array<double>")
    def measured(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        model, counts, totals = sent.value
        for langs, texts in batches:
            out, langs = [], langs.to_pylist()
            for first, group in shingles.groups(texts.to_pylist()):
                margins = np.zeros((len(group), model.words.shape[1]))
                for k, text in enumerate(group if len(model.languages) > 1 else ()):
                    margins[k] = _own_margins(model, counts, totals, langs[first + k], text)
                far = model.distance(margins) if margins.size else np.zeros(len(group))
                out += np.column_stack([model.familiarity(group, own=True), far]).tolist()
            yield pa.array(out, pa.list_(pa.float64()))

    by_language: dict[str, list] = {}
    for row in sample.select("lang", measured("lang", "text").alias("m")).collect():
        if row.m[0] >= LEAST:
            by_language.setdefault(row.lang, []).append(row.m[1:])
    if len(by_language) < len(model.languages):
        return  # a language known from short texts alone
    found = [np.array(rows) for rows in by_language.values()]
    model.most_unseen = max(STRANGE, 2 * max(np.quantile(f[:, 1], 0.99) for f in found))
    model.least_lettered = min(np.quantile(f[:, 0], 0.01) for f in found) / 2
    if len(found) > 1:
        model.farthest = max(FAR, 2 * max(np.quantile(f[:, 2], 0.99) for f in found))


def _calibrate(model: Model, sample: DataFrame) -> None:
    sent = sample.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<double>")
    def margins(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for _, group in shingles.groups(batch.to_pylist()):
                out += sent.value.margins(group).tolist()
            yield pa.array(out, pa.list_(pa.float64()))

    rows = sample.select("lang", margins("text").alias("m")).collect()
    truth = model.words[np.searchsorted(model.languages, [r.lang for r in rows])]
    found = np.array([r.m for r in rows])
    for bit in range(model.words.shape[1]):
        model.scale[bit], model.shift[bit] = _logistic(found[:, bit], truth[:, bit])
        right = (found[:, bit] * model.scale[bit] + model.shift[bit]) * truth[:, bit] > 0
        wrong = 1 - right.mean()
        model.trust[bit] = np.log((1 - wrong + 0.01) / (wrong + 0.01)).clip(0.01)
    model.trust /= model.trust.sum() / len(model.trust)


def predicted(documents: DataFrame, model: Model) -> Column:
    """The nearest language of column ``text`` and its score, as a struct."""
    ship(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang:string,score:double>")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = sent.value
        for batch in batches:
            langs, scores = [], []
            for _, group in shingles.groups(batch.to_pylist(), 1 << 19):
                if len(model.languages) < 2:
                    langs += [(model.languages or [UNKNOWN])[0]] * len(group)
                    scores += [float(len(model.languages))] * len(group)
                    continue
                nearest, score = model.decode(model.margins(group))
                langs += [model.languages[k] for k in nearest]
                scores += score.tolist()
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["lang", "score"]
            )
        arrays.release()

    return decoded(text_or_empty())


def judged(documents: DataFrame, model: Model, name: str) -> DataFrame:
    """``documents`` with ``name``: the struct of ``lang_pred, score, ambiguous``."""
    found = predicted(documents, model)
    known = letters()
    lang = F.when(known, found["lang"]).otherwise(F.lit(UNKNOWN))
    score = F.when(known, found["score"]).otherwise(F.lit(0.0))
    struct = F.struct(
        lang.alias("lang_pred"), score.alias("score"), (score < CERTAIN).alias("ambiguous")
    )
    return documents.withColumn(name, struct)


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """Per row: ``doc_id, lang_pred, score, ambiguous``."""
    return judged(documents.select("doc_id", "text"), model, "found").select("doc_id", "found.*")


def reject(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` without those in no known language."""
    ship(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def strange(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = sent.value
        for batch in batches:
            out = []
            for _, group in shingles.groups(batch.to_pylist(), 1 << 19):
                out += model.strange(group).tolist()
            yield pa.array(out, pa.bool_())
        arrays.release()

    known = documents.filter(letters())
    return known if model.seen is None else known.filter(~strange(text_or_empty()))


def held_out(modulus: int) -> Column:
    """The fold kept from training: crc32 of ``doc_id`` as text leaves 2. A null id is
    never held out."""
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus
    return F.coalesce(remainder == 2, F.lit(False))
