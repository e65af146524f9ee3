"""Scoring texts by a log-bilinear neural model, trained by noise-contrastive estimation.

Words are counted over the whole training corpus through the distinct words of blocks
(``words.py``). The model predicts classes: the ``SHORTLIST`` most frequent words, one
each; ``GROUPS`` classes of all other words, by their ending; and the end of the text. The
prediction from the two classes before is the sum of their vectors, each scaled by its
place; the score of a class is the product with its output vector, plus a bias, and a
softmax over all classes makes it a probability.

Inside a group the same prediction chooses the word. First its cell, the words of the group
in one hash shard; then, in the cell, a tree of choices among at most ``FAN`` branches, down
to the word. Every word seen ``OWN`` times or more has a vector of its own there, so vectors
grow with the vocabulary; rarer words of a cell are one branch with equal shares. Every
choice is a log-bilinear softmax whose biases are the counts, with one added for every word;
without a context it gives the share of the group's counts. All unseen words of a group
together count one. So the probabilities of all words, seen or not, add up to one.

Training: every task takes one pass over its training documents, from the same start, in
minibatches of numpy matrix products; each minibatch tells its true classes from
``NOISE`` shared draws of the unigram distribution. The parameters of all tasks are
averaged by their tokens, sixteen at a time. Then, with the vectors of the contexts fixed,
the choice of the cell is learned in the same way, and the choices inside a cell by descent
on the whole cell: the tokens of groups go to the shard of their word, which learns, scores
them, and answers with sums per document. Scoring computes the softmax over the classes once
per distinct context of a batch.

Every pass is bounded by a block, a batch or a shard; the driver sees the shortlist, sums
per cell, and one set of parameters of classes and cells.

Cases: a null or empty text is the end alone; rows with a null id are trained on; repeated
rows are counted and scored each; other columns are not read; without training rows all
counts are zero, the base score is 0 and the model starts from equal odds; an empty table
gives no rows.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import log10

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import arrays, words
from tidemark.llm.tables import partitions, texts, written

SHORTLIST, GROUPS = 447, 64
CLASSES = SHORTLIST + GROUPS + 1  # words, groups, end
END, BEGIN = CLASSES - 1, CLASSES  # BEGIN stands before a text and is never predicted
CONTEXT, DIMENSIONS, NOISE, MINIBATCH = 2, 16, 24, 2048
RATE = 0.08
OWN, FAN, STEPS = 2, 16, 6
CHUNK = 1 << 14
WIDE = 8  # bytes of a count over the corpus
BATCH_TOKENS = 1 << 20
AVERAGED = 16
_IS_BLANK = np.zeros(256, dtype=bool)
_IS_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_STOPS = b".,!?;:"


def is_held_out(doc_id: int | None, modulus: int) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % modulus == 2


def tokenise(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.Array]:
    """Runs of bytes that are no ASCII white space, with A-Z lower-cased."""
    parts = [text.encode() for text in batch.column("text").to_pylist()]
    data = np.frombuffer(b"\n".join(parts).lower() + b"\n", dtype=np.uint8)
    inside = ~_IS_BLANK[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    starts, ends = edges[::2], edges[1::2]
    text_starts = np.cumsum([0, *(len(p) + 1 for p in parts)])
    sizes = np.diff(np.searchsorted(starts, text_starts))
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
    return sizes, pa.Array.from_buffers(pa.large_binary(), len(starts), buffers)


def group_of(word: bytes) -> int:
    ending = (word.rstrip(_STOPS) or word)[-2:]
    return (ending[0] * 31 + ending[-1] * 7 + len(ending)) % GROUPS


@dataclass
class Counts:
    """What all tasks need to know of the corpus."""

    tokens: int  # N, with the ends
    distinct: int  # V
    ends: int
    codes: dict[int, np.ndarray]  # shard -> class of the words ranked there, -1 if none
    unigram: np.ndarray  # of the classes
    group_mass: np.ndarray  # log10 of what the shares of a group's words are divided by
    cell_mass: np.ndarray  # groups x shards: the words' counts, one added for each


SHARDS = (
    "shard int, block binary, places binary, counts binary, ranks binary, groups binary, "
    "leaves binary, top array<struct<word:binary,n:long>>, totals array<long>, kinds array<long>"
)
_SHARDS = pa.schema(
    [
        ("shard", pa.int32()),
        *((n, pa.binary()) for n in ("block", "places", "counts", "ranks", "groups", "leaves")),
        ("top", pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))),
        ("totals", pa.list_(pa.int64())),
        ("kinds", pa.list_(pa.int64())),
    ]
)


def _count_shard(rows: pa.Table) -> pa.Table:
    """The training counts of a shard's words, back to the blocks; and one row with the
    shard's most frequent words, its sums per group, and its leaves: the words by group,
    the rare ones last, counted from 1. Words are told apart once, by the numbers that a
    dictionary gives them; everything else is arithmetic on these."""
    table = rows.to_pylist()
    held = pa.concat_arrays([words.row_array(row) for row in table]).dictionary_encode()
    codes = held.indices.to_numpy(zero_copy_only=False)
    distinct = held.dictionary.to_pylist()
    ends = np.cumsum([0, *(len(arrays.expanded(row["places"])) for row in table)])
    totals = np.zeros(len(distinct), dtype=np.int64)
    for row, low, high in zip(table, ends[:-1], ends[1:]):  # a word once a row
        totals[codes[low:high]] += arrays.expanded(row["weights"]).astype(np.int64)
    groups = np.fromiter(map(group_of, distinct), np.int64, len(distinct))
    seen = np.flatnonzero(totals)
    top = heapq.nsmallest(SHORTLIST, ((-int(totals[k]), distinct[k], k) for k in _frequent(totals, seen)))
    ranks, leaves = (np.zeros(len(distinct), dtype=np.int64) for _ in range(2))
    ranks[[k for _, _, k in top]] = np.arange(1, len(top) + 1)
    by_word = seen[np.array(pa.compute.sort_indices(held.dictionary.take(pa.array(seen))), dtype=np.int64)]
    ordered = by_word[np.lexsort((totals[by_word] < OWN, groups[by_word]))]
    leaves[ordered] = np.arange(1, len(ordered) + 1)
    columns = {"counts": totals, "ranks": ranks, "groups": groups, "leaves": leaves}

    def packed(which: np.ndarray, name: str) -> bytes:
        return arrays.compressed(columns[name][which], WIDE if name == "counts" else 4)

    out = []
    for row, low, high in zip(table, ends[:-1], ends[1:]):
        answer = {k: row[k] for k in ("shard", "block", "places")}
        out.append(answer | {name: packed(codes[low:high], name) for name in columns})
    sums = np.zeros(GROUPS, dtype=np.int64)
    np.add.at(sums, groups, totals)
    out.append(
        {
            "shard": table[0]["shard"],
            **{name: packed(ordered, name) for name in ("counts", "ranks", "groups")},
            "top": [{"word": word, "n": -n} for n, word, _ in top],
            "totals": sums.tolist(),
            "kinds": np.bincount(groups[seen], minlength=GROUPS).tolist(),
        }
    )
    return pa.Table.from_pylist(out, schema=_SHARDS)


def _frequent(totals: np.ndarray, seen: np.ndarray) -> list[int]:
    """The words that can be among the SHORTLIST most frequent, ties included."""
    if len(seen) <= SHORTLIST:
        return seen.tolist()
    least = np.partition(totals[seen], -SHORTLIST)[-SHORTLIST]
    return seen[totals[seen] >= least].tolist()


def _counts(answers: DataFrame, ends: int, shards: int) -> Counts:
    summary = answers.filter(F.col("top").isNotNull())
    places = F.posexplode("top").alias("rank", "entry")
    top = (
        summary.select("shard", places)
        .select("shard", "rank", "entry.word", "entry.n")
        .orderBy(F.desc("n"), "word")
        .limit(SHORTLIST)
        .collect()
    )
    cells = np.zeros((2, GROUPS, shards))
    for row in summary.select("shard", "totals", "kinds").collect():
        cells[:, :, row.shard] = row.totals, row.kinds
    totals, kinds = cells.sum(axis=2)
    tokens, distinct = int(totals.sum()) + ends, int(kinds.sum()) + (ends > 0)
    codes: dict[int, np.ndarray] = {}
    unigram = np.zeros(CLASSES)
    for code, entry in enumerate(top):
        codes.setdefault(entry.shard, np.full(SHORTLIST + 1, -1, dtype=np.int64))[entry.rank + 1] = code
        unigram[code] = entry.n
        group = group_of(bytes(entry.word))
        totals[group] -= entry.n
        kinds[group] -= 1
        cells[:, group, entry.shard] -= entry.n, 1
    unigram[SHORTLIST : SHORTLIST + GROUPS] = totals
    unigram[END] = ends
    smooth = (unigram + 0.5) / (unigram + 0.5).sum()
    mass = np.log10(totals + kinds + 1)
    return Counts(tokens, distinct, ends, codes, smooth, mass, cells.sum(axis=0))


CODED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
    "in_groups double, codes binary, block binary, cells binary, leaves binary"
)
_CODED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("base_score", pa.float64()),
        ("in_groups", pa.float64()),
        ("codes", pa.binary()),
        ("block", pa.binary()),
        ("cells", pa.binary()),  # per token the shard of its word
        ("leaves", pa.binary()),  # and its leaf there, 0 outside groups and for unseen words
    ]
)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of stretches of ``values``; empty stretches are 0."""
    out = np.zeros(len(bounds) - 1)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        out[full] = np.add.reduceat(values, bounds[:-1][full])
    return out


def coded(documents: DataFrame, modulus: int) -> tuple[DataFrame, Counts]:
    """Every document as classes, with the sums that need a word's own count."""
    return coded_with_leaves(documents, modulus)[:2]


def coded_with_leaves(documents: DataFrame, modulus: int) -> tuple[DataFrame, Counts, DataFrame]:
    """The same, and the leaves of every shard."""
    spark = documents.sparkSession
    ready = texts(documents)

    def training(block: words.Block) -> np.ndarray:
        learned = [not is_held_out(i, modulus) for i in block.doc_ids.to_pylist()]
        weights = np.repeat(learned, block.sizes).astype(float)
        return np.bincount(block.codes, weights=weights, minlength=len(block.words)).astype(np.int64)

    shards = min(max(32, partitions(spark)), 1 << 16)
    found = words.word_rows(ready, shards, tokenise, training)
    answers = written(found.groupBy("shard").applyInArrow(_count_shard, SHARDS), "word-counts")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus
    learned = documents.select(F.coalesce(remainder != 2, F.lit(True)).alias("l")).filter("l")
    counts = _counts(answers, learned.count(), shards)
    sent = spark.sparkContext.broadcast(counts)

    def code(docs: pa.Table, replies: pa.Table) -> pa.Table:
        counts, rows = sent.value, replies.to_pylist()
        out: list[pa.Table] = []
        for row in docs.to_pylist():
            answer = words.Answers(row["n_words"], rows)
            n, group = answer.numbers("counts", WIDE), answer.numbers("groups")
            classes, leaves = SHORTLIST + group, answer.numbers("leaves")
            cells = np.zeros(row["n_words"], dtype=np.int64)
            for places, reply in answer.rows:
                cells[places] = reply["shard"]
                own = counts.codes.get(reply["shard"])
                if own is not None:
                    ranked = own[arrays.expanded(reply["ranks"])]
                    classes[places] = np.where(ranked >= 0, ranked, classes[places])
            leaves[classes < SHORTLIST] = 0
            logs = np.log10(n + 1)
            share = np.where(classes >= SHORTLIST, logs - counts.group_mass[group], 0.0)
            tokens = arrays.expanded(row["codes"])
            sizes = arrays.expanded(row["sizes"]).astype(np.int64)
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            base = _sums(logs[tokens], bounds) + log10(counts.ends + 1)
            base -= (sizes + 1) * log10(counts.tokens + counts.distinct + 1)
            known = _sums((n > 0)[tokens].astype(float), bounds).astype(np.int64)
            codes, cells = classes[tokens].astype("<u2"), cells[tokens].astype("<u2")
            leaves = leaves[tokens].astype("<u4")
            ids = row["doc_ids"]
            values = [
                ids,
                [is_held_out(i, modulus) for i in ids],
                sizes + 1,
                known + (counts.ends > 0),
                base,
                _sums(share[tokens], bounds),
                [codes[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])],
                [row["block"]] * len(ids),
                [cells[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])],
                [leaves[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])],
            ]
            arrays_ = [pa.array(v, f.type) for v, f in zip(values, _CODED)]
            out.append(pa.Table.from_arrays(arrays_, schema=_CODED))
        return pa.concat_tables([_CODED.empty_table(), *out])

    replies = answers.filter("block is not null").drop("top", "totals", "kinds")
    docs = words.doc_rows(ready, tokenise)
    joined = docs.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(code, CODED)
    # Numbered where it is written: later passes read the same numbers.
    numbered = joined.withColumn("row", F.monotonically_increasing_id())
    leaves = answers.filter("block is null").select("shard", "counts", "ranks", "groups")
    return written(numbered, "coded-documents"), counts, leaves


class Model:
    """Vectors of the classes as context and as prediction, biases, scales of the places."""

    SHAPES = [(CLASSES + 1, DIMENSIONS), (CLASSES, DIMENSIONS), (CLASSES,), (CONTEXT, DIMENSIONS)]

    def __init__(self, flat: np.ndarray):
        self.flat = flat
        self.parts, at = [], 0
        for shape in self.SHAPES:
            size = int(np.prod(shape))
            self.parts.append(flat[at : at + size].reshape(shape))
            at += size
        self.context, self.output, self.bias, self.scale = self.parts

    @classmethod
    def start(cls, unigram: np.ndarray) -> Model:
        """Small random vectors; the biases are the unigram distribution."""
        rng = np.random.default_rng(17)
        model = cls(np.empty(sum(int(np.prod(s)) for s in cls.SHAPES), dtype=np.float32))
        model.context[:] = rng.normal(0, 0.3, model.context.shape)
        model.output[:] = rng.normal(0, 0.1, model.output.shape)
        model.bias[:] = np.log(unigram)
        model.scale[:] = 1.0
        return model

    def predicted(self, contexts: np.ndarray) -> np.ndarray:
        return sum(self.context[contexts[:, k]] * self.scale[k] for k in range(CONTEXT))

    def log_probabilities(self, contexts: np.ndarray) -> np.ndarray:
        """Natural logs of the probabilities of all classes, per row of ``contexts``."""
        scores = self.predicted(contexts) @ self.output.T + self.bias
        scores -= scores.max(axis=1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def windows(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Contexts and targets of texts, each with its end: ``bounds`` are those of the texts
    among ``codes``."""
    n = len(bounds) - 1
    out = np.full(len(codes) + n * (CONTEXT + 1), BEGIN, dtype=np.int64)
    place = np.arange(len(codes)) + np.repeat(
        np.arange(n) * (CONTEXT + 1) + CONTEXT, np.diff(bounds)
    )
    out[place] = codes
    ends = bounds[1:] + np.arange(n) * (CONTEXT + 1) + CONTEXT
    out[ends] = END
    targets = np.flatnonzero(out != BEGIN)
    return np.stack([out[targets - k - 1] for k in range(CONTEXT)], axis=1), out[targets]


class Trainer:
    """One pass of noise-contrastive estimation with Adagrad steps."""

    def __init__(self, unigram: np.ndarray):
        self.model = Model.start(unigram)
        self.squares = Model(np.full(len(self.model.flat), 0.1, dtype=np.float32))
        self.unigram = unigram
        self.offset = (np.log(NOISE) + np.log(unigram)).astype(np.float32)
        self.rng = np.random.default_rng(23)

    def _step(self, which: int, gradient: np.ndarray) -> None:
        squares = self.squares.parts[which]
        squares += gradient * gradient
        self.model.parts[which] -= RATE * gradient / np.sqrt(squares)

    def learn(self, contexts: np.ndarray, targets: np.ndarray) -> None:
        order = self.rng.permutation(len(targets))
        for at in range(0, len(order), MINIBATCH):
            part = order[at : at + MINIBATCH]
            self._minibatch(contexts[part], targets[part])

    def _minibatch(self, contexts: np.ndarray, targets: np.ndarray) -> None:
        model, n = self.model, len(targets)
        noise = self.rng.choice(CLASSES, size=NOISE, p=self.unigram)
        held = [model.context[contexts[:, k]] for k in range(CONTEXT)]
        predicted = sum(h * model.scale[k] for k, h in enumerate(held))
        wanted, drawn = model.output[targets], model.output[noise]
        true = np.einsum("nd,nd->n", predicted, wanted) + model.bias[targets] - self.offset[targets]
        false = predicted @ drawn.T + (model.bias[noise] - self.offset[noise])
        # Slopes of the loss: how far each answer is from "true" and from "noise".
        up = -1 / (1 + np.exp(np.clip(true, -30, 30)))
        down = 1 / (1 + np.exp(np.clip(-false, -30, 30)))
        slope = up[:, None] * wanted + down @ drawn
        output = _scatter(targets, up[:, None] * predicted, CLASSES)
        output += _scatter(noise, down.T @ predicted, CLASSES)
        bias = np.bincount(targets, up, CLASSES) + np.bincount(noise, down.sum(axis=0), CLASSES)
        context = sum(
            _scatter(contexts[:, k], slope * model.scale[k], CLASSES + 1) for k in range(CONTEXT)
        )
        scale = np.stack([(slope * h).sum(axis=0) for h in held])
        for which, gradient in enumerate((context, output, bias, scale)):
            self._step(which, (gradient / n * 32).astype(np.float32))


def _scatter(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of ``values`` that go to the same of ``n`` rows."""
    width = values.shape[1]
    flat = (rows[:, None] * width + np.arange(width)).reshape(-1)
    return np.bincount(flat, values.reshape(-1), n * width).reshape(n, width)


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows of about BATCH_TOKENS tokens: first and last row, codes, bounds."""
    codes = batch.column("codes").to_pylist()
    sizes = np.array([len(c) // 2 for c in codes], dtype=np.int64)
    ends, low = np.cumsum(sizes), 0
    while low < len(codes):
        before = int(ends[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + BATCH_TOKENS, side="right")))
        part = np.frombuffer(b"".join(codes[low:high]), dtype="<u2").astype(np.int64)
        yield low, high, part, np.concatenate([[0], np.cumsum(sizes[low:high])])
        low = high


def _averaged(learned: DataFrame, rows: Callable) -> np.ndarray | None:
    """The mean by tokens of the parameters that ``rows`` gives in every task."""

    def average(rows: pa.Table) -> pa.Table:
        tokens = rows.column("tokens").to_numpy().astype(float)
        flat = sum(
            t * np.frombuffer(f.as_py(), dtype=np.float32).astype(float)
            for t, f in zip(tokens, rows.column("flat"))
        )
        mean = (flat / tokens.sum()).astype(np.float32).tobytes()
        return pa.table({"tokens": [int(tokens.sum())], "flat": [mean]}, schema=_PARAMETERS)

    found = written(learned.mapInArrow(arrays.released(rows), "tokens long, flat binary"), "task-models")
    n = found.count()
    while n > 1:
        groups = -(-n // AVERAGED)
        place = F.pmod(F.xxhash64("flat"), F.lit(groups)).alias("place")
        found = found.select("*", place).groupBy("place")
        found = found.applyInArrow(lambda t: average(t.drop_columns(["place"])), "tokens long, flat binary")
        found = written(found, "averaged-models")
        n = found.count()
    row = found.first()
    return None if row is None else np.frombuffer(bytes(row.flat), dtype=np.float32).copy()


def train(coded_docs: DataFrame, counts: Counts) -> Model:
    spark = coded_docs.sparkSession
    sent = spark.sparkContext.broadcast(counts.unigram)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, tokens = Trainer(sent.value), 0
        for batch in batches:
            for _, _, codes, bounds in _stretches(batch):
                contexts, targets = windows(codes, bounds)
                trainer.learn(contexts, targets)
                tokens += len(targets)
        if tokens:
            yield pa.RecordBatch.from_pydict(
                {"tokens": [tokens], "flat": [trainer.model.flat.tobytes()]}, schema=_PARAMETERS
            )

    flat = _averaged(coded_docs.filter("not held_out").select("codes"), rows)
    return Model.start(counts.unigram) if flat is None else Model(flat)


_PARAMETERS = pa.schema([("tokens", pa.int64()), ("flat", pa.binary())])


def class_scores(model: Model, contexts: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log-probability of every target; one softmax per distinct context."""
    key = (contexts[:, 0] * (CLASSES + 1) + contexts[:, 1]).astype(np.int32)
    order = np.argsort(key)
    new = np.concatenate([[True], np.diff(key[order]) != 0])
    first = np.flatnonzero(new)
    which = np.cumsum(new) - 1
    out = np.empty(len(targets))
    for at in range(0, len(first), 4096):
        logs = model.log_probabilities(contexts[order[first[at : at + 4096]]])
        low, high = np.searchsorted(which, [at, at + len(logs)])
        part = order[low:high]
        out[part] = logs[which[low:high] - at, targets[part]]
    return out


class Cells:
    """The choice of the cell inside each group."""

    def __init__(self, mass: np.ndarray, vectors: np.ndarray | None = None):
        shape = (*mass.shape, DIMENSIONS)
        self.bias = _log_mass(mass)
        self.vectors = np.zeros(shape, dtype=np.float32) if vectors is None else vectors.reshape(shape)
        self.shares = self.bias - _log_sum(self.bias)  # without a context

    def log_probabilities(self, group: int, predicted: np.ndarray) -> np.ndarray:
        scores = predicted @ self.vectors[group].T + self.bias[group]
        return scores - _log_sum(scores)


def _log_mass(mass: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(mass, 1e-30)).astype(np.float32)


def _log_sum(scores: np.ndarray) -> np.ndarray:
    high = scores.max(axis=-1, keepdims=True)
    return high + np.log(np.exp(scores - high).sum(axis=-1, keepdims=True))


def _in_groups(
    batch: pa.RecordBatch, low: int, high: int, codes: np.ndarray, bounds: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The tokens of a stretch with a leaf: places among the stretch's tokens, contexts,
    groups, cells, leaves."""
    parts = (b"".join(batch.column(c).slice(low, high - low).to_pylist()) for c in ("cells", "leaves"))
    cells, leaves = (np.frombuffer(p, dtype=t) for p, t in zip(parts, ("<u2", "<u4")))
    contexts, targets = windows(codes, bounds)
    at = np.flatnonzero(leaves)
    contexts = contexts[targets != END][at]
    return at, contexts, codes[at] - SHORTLIST, cells[at].astype(np.int64), leaves[at]


def _by_group(groups: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(groups.astype(np.uint8), kind="stable")
    bounds = np.concatenate([[0], np.cumsum(np.bincount(groups, minlength=GROUPS))])
    for group, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        for low in range(a, b, MINIBATCH):
            yield group, order[low : min(b, low + MINIBATCH)]


def train_cells(coded_docs: DataFrame, counts: Counts, model: Model) -> Cells:
    """One pass of Adagrad steps on the softmax over the cells of a token's group."""
    sent = coded_docs.sparkSession.sparkContext.broadcast((counts.cell_mass, model))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass, model = sent.value
        cells, tokens = Cells(mass), 0
        squares = np.full(cells.vectors.shape, 0.1, dtype=np.float32)
        for batch in batches:
            for stretch in _stretches(batch):
                at, contexts, groups, chosen, _ = _in_groups(batch, *stretch)
                tokens += len(at)
                for group, part in _by_group(groups):
                    predicted = model.predicted(contexts[part])
                    slope = cells.vectors[group] @ predicted.T + cells.bias[group][:, None]
                    np.exp(slope - slope.max(axis=0), out=slope)
                    slope /= slope.sum(axis=0)
                    slope[chosen[part], np.arange(len(part))] -= 1
                    gradient = slope @ predicted * (32 / MINIBATCH)
                    squares[group] += gradient * gradient
                    cells.vectors[group] -= RATE * gradient / np.sqrt(squares[group])
        if tokens:
            yield pa.RecordBatch.from_pydict(
                {"tokens": [tokens], "flat": [cells.vectors.tobytes()]}, schema=_PARAMETERS
            )

    learned = coded_docs.filter("not held_out").select("codes", "cells", "leaves")
    return Cells(counts.cell_mass, _averaged(learned, rows))


def fit(predicted: np.ndarray, counts: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Vectors of the branches of one choice: accelerated descent on the softmax loss of all
    its tokens, with a normal prior that keeps branches seen in few contexts near zero.
    ``counts`` has how often each branch (row) was chosen in each context (column)."""
    vectors = ahead = np.zeros((len(bias), DIMENSIONS), dtype=np.float32)
    total = counts.sum(axis=0)
    seen = np.flatnonzero(total)
    if not len(seen):
        return vectors
    predicted, total = predicted[seen], total[seen]
    made = counts[:, seen] @ predicted
    weighted = predicted * total[:, None]
    rate = np.float32(1 / (0.5 * np.linalg.eigvalsh(weighted.T @ predicted)[-1] + 1))
    parts = [(predicted[k : k + CHUNK].T.copy(), weighted[k : k + CHUNK]) for k in range(0, len(seen), CHUNK)]
    for step in range(STEPS):
        gradient = ahead - made
        for contexts, weights in parts:
            scores = ahead @ contexts
            scores += bias[:, None]
            scores -= scores.max(axis=0)
            np.exp(scores, out=scores)
            scores /= scores.sum(axis=0)
            gradient += scores @ weights
        before, vectors = vectors, ahead - rate * gradient
        ahead = vectors + np.float32(step / (step + 3)) * (vectors - before)
    return vectors


def tree(
    mass: np.ndarray,
    leaves: np.ndarray,
    predicted: np.ndarray,
    learned: np.ndarray,
    contexts: np.ndarray | None = None,
) -> np.ndarray:
    """Natural log-probability of every token inside one cell, whose leaves have ``mass``;
    tokens are in the order of their ``leaves``. Learned from the tokens ``learned``.
    ``predicted`` has a row per token, or per context if ``contexts`` gives the tokens' rows;
    every choice is computed once per distinct context, however often it was made."""
    out = np.zeros(len(leaves))
    if contexts is None:
        contexts = np.arange(len(leaves))
    stack = [(0, len(mass), 0, len(leaves))]
    while stack:
        low, high, first, last = stack.pop()
        if high - low < 2 or first == last:
            continue
        width = 1
        while width * FAN < high - low:
            width *= FAN
        edges = np.arange(low, high, width)
        bias = _log_mass(np.add.reduceat(mass[low:high], edges - low))
        own = leaves[first:last]
        held, which = np.unique(contexts[first:last], return_inverse=True)
        made = (own - low) // width * len(held) + which
        size = len(held) * len(edges)
        counts = np.bincount(made[learned[first:last]], minlength=size).astype(np.float32)
        mine = predicted[held]
        vectors = fit(mine, counts.reshape(len(edges), -1), bias)
        # A column per context: sums over the few branches run along memory.
        logs = np.empty((len(edges), len(held)), dtype=np.float32)
        for at in range(0, len(held), CHUNK):
            scores = vectors @ mine[at : at + CHUNK].T + bias[:, None]
            scores -= scores.max(axis=0)
            logs[:, at : at + CHUNK] = scores - np.log(np.exp(scores).sum(axis=0))
        out[first:last] += logs.reshape(-1)[made]
        if width > 1:
            bounds = first + np.searchsorted(own, [*edges, high])
            ends = [*edges[1:], high]
            stack += zip(edges.tolist(), ends, bounds[:-1].tolist(), bounds[1:].tolist())
    return out


MESSAGES = "shard int, block binary, rows array<long>, held_out binary, places binary, contexts binary, leaves binary"
ANSWERED = "block binary, rows array<long>, sums array<double>"


def inside_cells(coded_docs: DataFrame, counts: Counts, leaves: DataFrame, model: Model) -> DataFrame:
    """Learn the choices inside all cells. Per shard and run of documents: the rows of the
    documents, and by how much (log10) context changes the share of their words in cells."""
    sent = coded_docs.sparkSession.sparkContext.broadcast((counts.codes, model))

    def messages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            blocks = whole.column("block").to_pylist()
            cuts = [0, *(k for k in range(1, len(blocks)) if blocks[k] != blocks[k - 1]), len(blocks)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                batch = whole.slice(a, b - a)
                for low, high, codes, bounds in _stretches(batch):
                    at, contexts, _, cells, own = _in_groups(batch, low, high, codes, bounds)
                    key = contexts[:, 0] * (CLASSES + 1) + contexts[:, 1]
                    place = np.searchsorted(bounds, at, side="right") - 1
                    rows = batch.column("row").to_numpy()[low:high]
                    held = np.array(batch.column("held_out").to_pylist()[low:high])
                    order = np.argsort(cells.astype(np.uint16), kind="stable")
                    edges = np.flatnonzero(np.diff(cells[order], prepend=-1, append=-1))
                    for c, d in zip(edges[:-1], edges[1:]):
                        part = order[c:d]
                        held_in = place[part]  # ascending, as the tokens of a cell stay in order
                        new = np.diff(held_in, prepend=-1) != 0
                        docs, of = held_in[new], np.cumsum(new) - 1
                        yield pa.RecordBatch.from_pydict(
                            {
                                "shard": [int(cells[part[0]])],
                                "block": [blocks[a]],
                                "rows": [rows[docs]],
                                "held_out": [held[docs].tobytes()],
                                "places": [arrays.compressed(of)],
                                "contexts": [arrays.compressed(key[part])],
                                "leaves": [arrays.compressed(own[part])],
                            },
                            schema=_MESSAGES,
                        )

    def learn(found: pa.Table, leaves: pa.Table) -> pa.Table:
        top, model = sent.value
        table = found.select(["block", "rows", "held_out"]).to_pylist()
        places, contexts, leaf = ([arrays.expanded(v.as_py()) for v in found.column(c)]
                                  for c in ("places", "contexts", "leaves"))
        held = [np.frombuffer(r["held_out"], dtype=bool)[p] for r, p in zip(table, places)]
        if not table:
            return _ANSWERED.empty_table()
        sizes = np.cumsum([0, *map(len, leaf)])
        leaf, contexts = np.concatenate(leaf).astype(np.int64) - 1, np.concatenate(contexts)
        learned = ~np.concatenate(held)
        answer = leaves.to_pylist()[0]
        n = arrays.expanded(answer["counts"], WIDE).astype(np.int64)
        ranks, groups = (arrays.expanded(answer[c]).astype(np.int64) for c in ("ranks", "groups"))
        mass = n + 1.0
        if answer["shard"] in top:
            mass[top[answer["shard"]][ranks] >= 0] = 0  # they are classes
        # Every distinct context of the shard once: a bounded number, whatever is read.
        keys, contexts = np.unique(contexts, return_inverse=True)
        pairs = np.stack([keys // (CLASSES + 1), keys % (CLASSES + 1)], axis=1).astype(np.int64)
        predicted, contexts = model.predicted(pairs), contexts.astype(np.int32)
        order = np.argsort(leaf.astype(np.int32))
        starts = np.searchsorted(groups, np.arange(GROUPS + 1))
        bounds = np.searchsorted(leaf[order], starts)
        logs = np.zeros(len(leaf))
        for low, high, first, last in zip(starts[:-1], starts[1:], bounds[:-1], bounds[1:]):
            if first == last:
                continue
            part = order[first:last]
            rare = low + int((n[low:high] >= OWN).sum())
            held_mass = mass[low:rare]
            if rare < high:
                held_mass = np.append(held_mass, mass[rare:high].sum())
            own = leaf[part]
            own_leaves = np.minimum(own, rare) - low
            logs[part] = tree(held_mass, own_leaves, predicted, learned[part], contexts[part])
            branch = held_mass[np.minimum(own, rare) - low]
            logs[part] -= np.log(branch / held_mass.sum())
        out = {"block": [r["block"] for r in table], "rows": [r["rows"] for r in table]}
        out["sums"] = [
            np.bincount(p, logs[a:b] / np.log(10), len(r["rows"]))
            for r, p, a, b in zip(table, places, sizes[:-1], sizes[1:])
        ]
        return pa.table(out, schema=_ANSWERED)

    columns = coded_docs.select("row", "held_out", "block", "codes", "cells", "leaves")
    sent_out = columns.mapInArrow(arrays.released(messages), MESSAGES)
    return sent_out.groupBy("shard").cogroup(leaves.groupBy("shard")).applyInArrow(learn, ANSWERED)


_MESSAGES = pa.schema(
    [("shard", pa.int32()), ("block", pa.binary()), ("rows", pa.list_(pa.int64()))]
    + [(n, pa.binary()) for n in ("held_out", "places", "contexts", "leaves")]
)
_ANSWERED = pa.schema(
    [("block", pa.binary()), ("rows", pa.list_(pa.int64())), ("sums", pa.list_(pa.float64()))]
)


def score(documents: DataFrame, modulus: int = 7) -> DataFrame:
    """Per row ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.
    Held out is crc32 of the id as text leaving 2 modulo ``modulus``; all else is learned
    from."""
    rows, counts, leaves = coded_with_leaves(documents, modulus)
    model = train(rows, counts)
    cells = train_cells(rows, counts, model)
    sent = documents.sparkSession.sparkContext.broadcast((model, cells))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, choice = sent.value
        for batch in batches:
            for low, high, codes, bounds in _stretches(batch):
                contexts, targets = windows(codes, bounds)
                logs = class_scores(model, contexts, targets)
                ends = bounds + np.arange(len(bounds))
                total = np.add.reduceat(logs, ends[:-1]) / np.log(10)
                at, contexts, groups, chosen, _ = _in_groups(batch, low, high, codes, bounds)
                gains = np.zeros(len(codes))
                for group, places in _by_group(groups):
                    own = chosen[places]
                    logs = choice.log_probabilities(group, model.predicted(contexts[places]))
                    gains[at[places]] = logs[np.arange(len(own)), own] - choice.shares[group, own]
                total += _sums(gains, bounds) / np.log(10)
                part = batch.slice(low, high - low)
                values = part.column("in_groups").to_numpy() + total
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in _KEPT), pa.array(values)], names=[*_KEPT, "score"]
                )

    def add(docs: pa.Table, answers: pa.Table) -> pa.Table:
        order = np.argsort(docs.column("row").to_numpy(), kind="stable")
        docs = docs.take(pa.array(order))
        total = docs.column("score").to_numpy().copy()
        for answer in answers.to_pylist():
            total[np.searchsorted(docs.column("row").to_numpy(), answer["rows"])] += answer["sums"]
        kept = docs.select(_KEPT[2:])
        return kept.append_column("score", pa.array(total))

    kinds = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    found = rows.mapInArrow(arrays.released(scored), f"row long, block binary, {kinds}")
    inside = inside_cells(rows, counts, leaves, model)
    found = found.groupBy("block").cogroup(inside.groupBy("block")).applyInArrow(add, kinds)
    return found.withColumn("train_tokens", F.lit(counts.tokens).cast("long"))


_KEPT = ["row", "block", "doc_id", "held_out", "n_tokens", "n_known", "base_score"]
