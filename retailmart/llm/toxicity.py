"""Toxicity: a convolutional text classifier, trained in numpy, applied by Spark.

A word (a run of ASCII letters, digits and bytes above 127, lower-cased) is three hashed
features: the word and its first 4 and 6 bytes, so inflected forms share features; its
embedding is the sum of theirs.  Filters of widths 1, 2 and 3 slide over the embeddings,
the largest response of each over the whole text (max pooling) feeds a logistic output.
The score depends on the text alone.

Training reads every labelled document.  Their hashed words are written once; in each of
``ROUNDS`` rounds every partition of them improves its own copy of the model, and the mean
of the copies (of a word's embedding: over the copies that met the word) is the next
model.  No row reaches the driver, which holds one model (about 2 MB).  Then all labelled
documents are scored, and for every language that has ``least`` of both labels a threshold
is chosen from the counts of both labels in ``BINS`` bins of the score, all rows counted:
the middle of the longest stretch of bin edges that separate the labels best; other
languages, and rows without one, use ``THRESHOLD``.  Scoring goes through a batch in slices
of bounded size, so what a task holds beside the batch does not grow with it.

Defined results: null and empty texts have no words and get the score of the bias; rows
are scored one by one, so ties, repeats and extra columns change nothing; without any
usable label, or with one label only, training is an error.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, Rolling, text_chunks, written

BUCKETS = 1 << 15
WIDTHS = (1, 2, 3)
FILTERS = 8
DIM = 16
THRESHOLD = 0.7
#: rounds of training, and the steps of BATCH rows in a round: more than one pass over few rows
ROUNDS = 3
STEPS = 400
BATCH = 32
#: rows, or words of their texts, that a partition trains on at a time; words that are scored at a
#: time (scoring takes about 200 bytes a word); words of the model that are averaged in one group
AT_ONCE = 8192
WORDS_AT_ONCE = 1 << 23
WORDS_SCORED = 1 << 17
WORDS_A_GROUP = 1024
PIECE = 1 << 16
BINS = 1 << 12
#: zero vectors after every text, so that no window reaches into the next one
PAD = max(WIDTHS) - 1

WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words x 3 hashed features, offsets of the rows) of a buffer of texts.

    Feature 0 is the zero vector; every text ends with ``PAD`` words of it.
    """
    data = LOWER[data]
    word = WORD_BYTE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[off] = True
    start = np.flatnonzero(word & (~np.r_[False, word[:-1]][:len(word)] | cut[:-1]))
    end = np.flatnonzero(word & (~np.r_[word[1:], False][:len(word)] | cut[1:])) + 1
    row = np.searchsorted(off, start, "right") - 1
    rolling = Rolling(data)
    found = np.zeros((len(start), 3), np.int32)
    for j, most in enumerate((1 << 40, 4, 6)):
        found[:, j] = (rolling.of(start, np.minimum(end, start + most)) + np.uint64(j)) % np.uint64(BUCKETS - 1) + np.uint64(1)
    n = np.bincount(row, minlength=len(off) - 1) if len(row) else np.zeros(len(off) - 1, np.int64)
    out = np.r_[0, np.cumsum(n + PAD)]
    table = np.zeros((int(out[-1]), 3), np.int32)
    table[np.arange(len(start)) + row * PAD] = found
    return table, out


@dataclass
class Model:
    embedding: np.ndarray
    kernels: list[np.ndarray]
    shift: list[np.ndarray]
    weight: np.ndarray
    bias: float
    thresholds: dict[str, float] = field(default_factory=dict)

    def responses(self, table: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Embeddings of the words, and for each width the filters' responses from each word."""
        x = self.embedding[table[:, 0]]
        x += self.embedding[table[:, 1]]
        x += self.embedding[table[:, 2]]
        out = []
        for w, kernel, shift in zip(WIDTHS, self.kernels, self.shift):
            z = x @ kernel[0]
            for j in range(1, w):
                z[:-j] += x[j:] @ kernel[j]
            out.append(z + shift)
        return x, out

    def scores(self, table: np.ndarray, off: np.ndarray) -> np.ndarray:
        if len(off) == 1:
            return np.zeros(0)
        _, z = self.responses(table)
        pooled = np.maximum(np.concatenate([np.maximum.reduceat(r, off[:-1]) for r in z], axis=1), 0)
        return 1 / (1 + np.exp(-(pooled @ self.weight + self.bias).astype(np.float64)))


@dataclass
class State:
    """A model in training, with the sums of squared gradients that Adagrad keeps."""

    model: Model
    seen: dict

    def dense(self) -> list[np.ndarray]:
        """All but the embedding, as arrays that can be written to."""
        m, s = self.model, self.seen
        return [*m.kernels, *m.shift, m.weight, *s["k"], *s["s"], s["w"], s["b"]]


def start(seed: int = 7) -> State:
    rng, f32 = np.random.default_rng(seed), np.float32
    model = Model((rng.standard_normal((BUCKETS, DIM)) * 0.01).astype(f32),
                  [(rng.standard_normal((w, DIM, FILTERS)) * 0.3).astype(f32) for w in WIDTHS],
                  [np.zeros(FILTERS, f32) for _ in WIDTHS], (rng.standard_normal(FILTERS * len(WIDTHS)) * 0.3).astype(f32), 0.0)
    model.embedding[0] = 0
    return State(model, {"e": np.full((BUCKETS, 1), 1e-2, f32), "w": np.full_like(model.weight, 1e-2), "b": np.full(1, 1e-2),
                         "k": [np.full_like(k, 1e-2) for k in model.kernels], "s": [np.full_like(s, 1e-2) for s in model.shift]})


def train(state: State, tables: list[np.ndarray], labels: np.ndarray, share: dict[int, float], passes: int, rng: np.random.Generator,
          rate: float = 0.02, dropped: float = 0.3) -> np.ndarray:
    """Improve ``state`` by Adagrad on the logistic loss over ``passes`` passes; the words it changed.

    A row counts ``share`` of its label.  Each time a text is seen, a part of its words is left
    out, so that max pooling does not learn one telling word a text only.
    """
    f32, model, seen = np.float32, state.model, state.seen
    weights, changed = np.where(labels == 1, share[1], share[0]), np.zeros(BUCKETS, bool)
    order = np.concatenate([rng.permutation(len(tables)) for _ in range(passes)])
    for lo in range(0, len(order), BATCH):
        pick = order[lo:lo + BATCH]
        off = np.r_[0, np.cumsum([len(tables[i]) for i in pick])]
        table = np.concatenate([tables[i] for i in pick])
        table = np.where(rng.random((len(table), 1)) < dropped, 0, table)
        x, z = model.responses(table)
        best = [np.stack([a + r[a:b].argmax(0) for a, b in zip(off[:-1], off[1:])]) for r in z]
        pooled = np.concatenate([np.take_along_axis(r, p, 0) for r, p in zip(z, best)], axis=1)
        live = pooled > 0
        pooled = pooled * live
        score = 1 / (1 + np.exp(-(pooled @ model.weight + model.bias)))
        wrong = ((score - labels[pick]) * weights[pick] / BATCH).astype(f32)
        back = wrong[:, None] * model.weight * live
        gradient = np.zeros_like(x)
        for i, w in enumerate(WIDTHS):
            g = back[:, i * FILTERS:(i + 1) * FILTERS]
            for j in range(w):
                at = np.minimum(best[i] + j, len(x) - 1)
                inside = (best[i] + j < len(x))[..., None]
                step = (x[at] * inside * g[..., None]).sum(0).T
                np.add.at(gradient, at.ravel(), (g[..., None] * inside * model.kernels[i][j].T[None]).reshape(-1, DIM))
                seen["k"][i][j] += step**2
                model.kernels[i][j] -= rate * step / np.sqrt(seen["k"][i][j])
            step = g.sum(0)
            seen["s"][i] += step**2
            model.shift[i] -= rate * step / np.sqrt(seen["s"][i])
        step = pooled.T @ wrong
        seen["w"] += step**2
        model.weight -= rate * step / np.sqrt(seen["w"])
        seen["b"] += float(wrong.sum()) ** 2
        model.bias -= rate * float(wrong.sum()) / float(seen["b"][0]) ** 0.5
        touched = np.flatnonzero(gradient.any(1))
        ids, place = np.unique(table[touched], return_inverse=True)
        total = np.zeros((len(ids), DIM), f32)
        np.add.at(total, place.ravel(), np.repeat(gradient[touched], 3, axis=0))
        total[ids == 0] = 0
        seen["e"][ids] += (total**2).mean(1, keepdims=True)
        model.embedding[ids] -= rate * total / np.sqrt(seen["e"][ids])
        changed[ids] = True
    changed[0] = False
    return changed


def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, off in text_chunks(batch, "text"):
            table, at = features(data, off)
            words = pa.ListArray.from_arrays(pa.array((at * 3).astype(np.int32)), pa.array(table.astype(np.int16).ravel()))
            yield pa.record_batch([*(batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "toxic", "lang")), words], names=["doc_id", "toxic", "lang", "words"])


def word_tables(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """What ``features`` made of the texts of a batch of ``hashed`` rows, in place and in 16 bits."""
    words = batch.column("words")
    off = words.offsets.to_numpy()
    return words.values.to_numpy()[off[0]:off[-1]].reshape(-1, 3), (off - off[0]) // 3


def word_slices(batch: pa.RecordBatch, most: int = WORDS_SCORED) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, their words, offsets) of slices of about ``most`` words and whole rows of ``hashed`` rows."""
    table, off = word_tables(batch)
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
        yield batch.slice(lo, hi - lo), table[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def improved(rows: DataFrame, state: State, share: dict[int, float], passes: int, number: int) -> State:
    """The mean of the models that the partitions of ``rows`` make of ``state`` over all their rows."""
    shared = rows.sparkSession.sparkContext.broadcast(state)

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, changed, n, first = copy.deepcopy(shared.value), np.zeros(BUCKETS, bool), 0, None
        for ids, labels, tables in held(batches):
            order = np.argsort(ids, kind="stable")
            first = int(ids.min()) if first is None else min(first, int(ids.min()))
            rng = np.random.default_rng([number, n, *ids[order[:1]].view(np.uint64)])
            changed |= train(mine, [tables[i] for i in order], labels[order], share, passes, rng)
            n += len(ids)
        if not n:
            return
        out = [(-1, first, n, b"", np.concatenate([np.ravel(a) for a in mine.dense()] + [[mine.model.bias]]).astype(np.float64).tobytes())]
        for lo in range(0, BUCKETS, WORDS_A_GROUP):
            ids = lo + np.flatnonzero(changed[lo:lo + WORDS_A_GROUP]).astype(np.int32)
            if len(ids):
                out.append((lo // WORDS_A_GROUP, first, n, ids.tobytes(), np.hstack([mine.model.embedding[ids], mine.seen["e"][ids]]).tobytes()))
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["place", "first", "n", "ids", "vals"])

    def mean(copies: pa.Table) -> pa.Table:
        copies, place = copies.sort_by("first"), copies["place"][0].as_py()
        if place < 0:
            n = copies["n"].to_numpy().astype(np.float64)
            ids, vals = b"", (sum(np.frombuffer(v.as_py(), np.float64) * k for v, k in zip(copies["vals"], n)) / n.sum()).tobytes()
        else:
            total, n = np.zeros((WORDS_A_GROUP, DIM + 1)), np.zeros((WORDS_A_GROUP, 1))
            for i, v, k in zip(copies["ids"], copies["vals"], copies["n"].to_pylist()):
                at = np.frombuffer(i.as_py(), np.int32) - place * WORDS_A_GROUP
                total[at] += k * np.frombuffer(v.as_py(), np.float32).reshape(-1, DIM + 1).astype(np.float64)
                n[at] += k
            met = np.flatnonzero(n[:, 0])
            ids, vals = (met + place * WORDS_A_GROUP).astype(np.int32).tobytes(), (total[met] / n[met]).astype(np.float32).tobytes()
        return pa.table({"place": pa.array([place], pa.int32()), "ids": pa.array([ids], pa.binary()), "vals": pa.array([vals], pa.binary())})

    copies = rows.mapInArrow(learned, "place int, first long, n long, ids binary, vals binary")
    found = copies.groupBy("place").applyInArrow(mean, "place int, ids binary, vals binary").collect()
    new = copy.deepcopy(state)
    for place, ids, vals in found:
        if place < 0:
            flat = np.frombuffer(bytes(vals), np.float64)
            for a in new.dense():
                a[...], flat = flat[:a.size].reshape(a.shape), flat[a.size:]
            new.model.bias = float(flat[0])
        else:
            at, vals = np.frombuffer(bytes(ids), np.int32), np.frombuffer(bytes(vals), np.float32).reshape(-1, DIM + 1)
            new.model.embedding[at], new.seen["e"][at] = vals[:, :DIM], vals[:, DIM:]
    shared.unpersist()
    return new


def held(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """(ids, labels, word tables) of about ``AT_ONCE`` rows of ``hashed`` at a time, fewer of long texts."""
    ids, labels, tables, n, words = [], [], [], 0, 0
    for batch in batches:
        table, off = word_tables(batch)
        ids.append(batch.column("doc_id").to_numpy(zero_copy_only=False))
        labels.append(batch.column("toxic").to_numpy(zero_copy_only=False))
        tables += np.split(table, off[1:-1]) if batch.num_rows else []
        n, words = n + batch.num_rows, words + len(table)
        if n >= AT_ONCE or words >= WORDS_AT_ONCE:
            yield np.concatenate(ids), np.concatenate(labels), tables
            ids, labels, tables, n, words = [], [], [], 0, 0
    if n:
        yield np.concatenate(ids), np.concatenate(labels), tables


def calibrated(rows: DataFrame, model: Model, least: int = 20, cost: float = 5.0) -> dict[str, float]:
    """For each language with enough labels in ``rows``, the threshold with the least costly errors.

    A clean document rejected costs ``cost`` times a toxic one kept (toxic documents are a
    larger part of the labelled ones than of a corpus).  Every row counts, in one of ``BINS``
    bins of its score; of several such places the longest stretch of neighbouring bin edges
    holds, and the threshold is its middle edge.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, table, off in word_slices(batch):
                scores = shared.value.scores(table, off)
                yield pa.record_batch([rows.column("lang"), pa.array(np.minimum((scores * BINS).astype(np.int32), BINS - 1)), rows.column("toxic")], names=["lang", "bin", "toxic"])

    def best(counts: pa.Table) -> pa.Table:
        clean, toxic = np.zeros(BINS, np.int64), np.zeros(BINS, np.int64)
        clean[counts["bin"].to_numpy()], toxic[counts["bin"].to_numpy()] = counts["clean"].to_numpy(), counts["toxic"].to_numpy()
        names, edges = counts["lang"][:1], np.zeros(1)
        if min(clean.sum(), toxic.sum()) < least:
            return pa.table({"lang": names[:0], "threshold": edges[:0]})
        errors = np.cumsum(np.r_[0, toxic]) + cost * (clean.sum() - np.cumsum(np.r_[0, clean]))
        change = np.diff(np.r_[0, (errors == errors.min()).astype(np.int8), 0])
        lo, hi = np.flatnonzero(change == 1), np.flatnonzero(change == -1) - 1
        i = int(np.argmax(hi - lo))
        edges[0] = int(lo[i] + hi[i]) // 2 / BINS
        return pa.table({"lang": names, "threshold": edges})

    counts = (rows.where("lang IS NOT NULL").mapInArrow(binned, "lang string, bin int, toxic int")
              .groupBy("lang", "bin").agg(F.count_if(F.col("toxic") == 0).alias("clean"), F.count_if(F.col("toxic") == 1).alias("toxic")))
    return {lang: limit for lang, limit in counts.groupBy("lang").applyInArrow(best, "lang string, threshold double").collect()}


def with_labels(docs: DataFrame, known: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the label that ``known`` (one row a doc_id) holds for them.

    Labels may cover few documents, and are too many to broadcast: a bit set of their ids'
    hashes (16 bits an id, 8 MB at most) keeps most of the other texts out of the shuffle, and
    the join decides.
    """
    size = 1 << min(26, max(16, (16 * known.count()).bit_length()))
    bit = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(size))

    def packed(hits: pa.Table) -> pa.Table:
        bits = np.zeros(PIECE, bool)
        bits[hits["bit"].to_numpy() % PIECE] = True
        return pa.table({"piece": hits["piece"][:1], "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    bits = np.zeros(size // 8, np.uint8)
    hits = known.select(bit.alias("bit")).select("bit", F.call_function("div", F.col("bit"), F.lit(PIECE)).alias("piece"))
    for piece, found in hits.groupBy("piece").applyInArrow(packed, "piece long, bits binary").collect():
        bits[piece * PIECE // 8:(piece + 1) * PIECE // 8] = np.frombuffer(bytes(found), np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    @F.arrow_udf("boolean")
    def maybe(at: pa.Array) -> pa.Array:
        x = at.to_numpy(zero_copy_only=False)
        return pa.array((shared.value[x >> 3] >> (x & 7).astype(np.uint8)) & 1 == 1)

    return docs.where("doc_id IS NOT NULL").where(maybe(bit)).join(known.hint("merge"), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None) -> Model:
    """Train on all rows of ``labels`` (doc_id, toxic) for which ``usable`` holds; see the module."""
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL")
    known = (known if usable is None else known.where(usable)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    texts = with_labels(docs.select("doc_id", "lang", "text"), known)
    rows = written(texts.mapInArrow(hashed, "doc_id long, toxic int, lang string, words array<smallint>"), "labelled-words")
    counts = dict(rows.groupBy("toxic").count().collect())
    if len(counts) < 2:
        raise ValueError("training needs documents of both labels")
    n = sum(counts.values())
    share = {label: 0.5 * n / k for label, k in counts.items()}  # as if the labels were equally many
    passes = max(1, -(-STEPS * BATCH // n))
    state = start()
    for i in range(ROUNDS):
        # few rows make one model: copies that saw a few hundred rows each have little to average
        state = improved(rows.coalesce(-(-n // AT_ONCE)), state, share, passes, i)
    state.model.thresholds = calibrated(rows, state.model)
    return state.model


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, threshold) of every row; the threshold is its language's."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, scores, limits in scored(shared.value, batch):
                yield pa.record_batch([rows.column("doc_id"), pa.array(scores), pa.array(limits)], names=["doc_id", "score", "threshold"])

    return docs.select("doc_id", "lang", "text").mapInArrow(work, "doc_id long, score double, threshold double")


def scored(model: Model, batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, scores of their ``text``, thresholds by their ``lang``) of slices of a batch."""
    for lo, hi, data, off in text_chunks(batch, "text"):
        rows = batch.slice(lo, hi - lo)
        limits = [model.thresholds.get(x, THRESHOLD) for x in rows.column("lang").to_pylist()]
        yield rows, model.scores(*features(data, off)), np.array(limits, np.float64)


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` below their language's threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, scores, limits in scored(shared.value, batch):
                yield rows.filter(pa.array(scores < limits))

    return docs.mapInArrow(work, docs.schema)
