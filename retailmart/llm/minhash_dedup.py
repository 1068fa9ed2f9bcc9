"""Near duplicates by MinHash bands, odd sketches and confirmation on full shingle sets.

1. Every text becomes its set of word shingles (64-bit hashes).  125 MinHash samples give
   band keys, and an odd sketch: each (sample number, value) flips one bit of a bitmap, so
   the number of ones in the XOR of two bitmaps estimates how many samples differ, most
   precisely where few do.
2. Texts with equal sets form a class; only its representative (smallest doc_id) goes on.
3. Representatives that share a band key are compared by sketch.  The pairs that pass (the
   limit is 4.5 standard deviations on the far side of the similarity asked for) are
   reduced to a forest inside the task; its components hold all pairs that can be links.
4. Inside a component, intersections of the full sets are counted by matrix products over
   the shared shingles.  Links are again reduced to a forest, whose components are the
   result.  So no task emits more links than it has members, whatever the size of a group.

A bucket or component larger than a block is split into blocks.  Each block is compared
with itself and one of them, the hub, which settles the members that this connects with the
hub's largest component: they are in one component, so links between them add nothing.
Only the others, the loose ones, are compared with all members, in pairs of blocks; nothing
is capped.  A link is missed only if no band key is
shared (below one in a million at the limit, less above it) or by the sketch limit (about
3 in a million there).

Defined results: null and empty texts have an empty set and are linked with nothing; texts
with fewer words than a shingle have the whole sequence as their only shingle; rows that
repeat a doc_id count as one document; rows without a doc_id are linked with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, Rolling, beside_hub, forest, loose_to_all, mix, run_starts, text_chunks, to_hub, whole_runs, word_spans, written
from .components import connected_components

SAMPLES = 125
SKETCH_BITS = 256
BUCKET_BLOCK = 1024
SET_BLOCK = 256
SET_BLOCK_SHINGLES = 200_000
# links; rows without b are loose members a of a group, with its blocks and their own share of a block
FOUND = "a long, b long, group long, blocks int, load double"
POPCOUNT = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


def band_rows(percent: int, missed: float = 1e-6) -> int:
    """The largest number of samples a band for which a pair at the limit is rarely missed."""
    s = percent / 100
    return max([r for r in range(1, 26) if (1 - s**r) ** (SAMPLES // r) <= missed], default=1)


def sketch_limit(percent: int, sigmas: float = 4.5) -> int:
    """Most ones in the XOR of two sketches for which the pair may still be a link."""
    far = 1 - percent / 100
    differ = min(SAMPLES, SAMPLES * far + sigmas * (SAMPLES * far * (1 - far)) ** 0.5)
    ones = SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** (2 * differ))
    return int(ones + 1.5 * SKETCH_BITS**0.5 / 2)


def shingles(data: np.ndarray, off: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of a buffer of texts, sorted by both."""
    data = LOWER[data]
    start, end, row = word_spans(data, off)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = Rolling(data).of(start, end)
    n = np.bincount(row, minlength=len(off) - 1)
    first = np.r_[0, np.cumsum(n)]
    place = np.arange(len(h))
    last = first[row + 1]
    short = (n[row] < words) & (place == first[row])
    at = np.flatnonzero((place + words <= last) | short)
    value = np.zeros(len(at), np.uint64)
    for j in range(words):
        inside = at + j < last[at]
        value[inside] = mix(value[inside] + h[at[inside] + j] + np.uint64(j + 1))
    order = np.lexsort((value, row[at]))
    r, v = row[at][order], value[order]
    new = np.r_[True, (r[1:] != r[:-1]) | (v[1:] != v[:-1])]
    return r[new], v[new]


def signatures(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, bands, sketch) of every row; the set's two hashes name it."""
    rows = band_rows(percent)
    n_bands = SAMPLES // rows
    rng = np.random.default_rng(11)
    flip, factor = rng.integers(0, 2**63, SAMPLES, np.uint64), rng.integers(0, 2**63, SAMPLES, np.uint64) * np.uint64(2) + np.uint64(1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in text_chunks(batch, "text"):
                row, value = shingles(data, off, words)
                n = np.bincount(row, minlength=hi - lo)
                filled = np.flatnonzero(n)
                starts = np.r_[0, np.cumsum(n[filled])][:-1]
                name = np.zeros((2, hi - lo), np.uint64)
                bands = np.zeros((len(filled), n_bands), np.uint64)
                bits = np.zeros((hi - lo, SKETCH_BITS), np.uint8)
                if len(filled):
                    for i, salt in enumerate((1, 2)):
                        name[i, filled] = np.add.reduceat(mix(value + np.uint64(salt)), starts)
                    for i in range(SAMPLES):
                        least = np.minimum.reduceat((value ^ flip[i]) * factor[i], starts)
                        if i < n_bands * rows:
                            bands[:, i // rows] = mix(bands[:, i // rows] + least + np.uint64(i // rows + 1))
                        bits[filled, (mix(least + np.uint64(i)) % np.uint64(SKETCH_BITS)).astype(np.int64)] ^= 1
                at = np.zeros(hi - lo + 1, np.int32)
                at[1:] = np.cumsum((n > 0) * n_bands)
                yield pa.record_batch([batch.column("doc_id").slice(lo, hi - lo), pa.array(n.astype(np.int64)), pa.array(name[0].view(np.int64)), pa.array(name[1].view(np.int64)),
                                       pa.ListArray.from_arrays(pa.array(at), pa.array(bands.ravel().view(np.int64))), pa.array([x.tobytes() for x in np.packbits(bits, axis=1)], pa.binary())],
                                      names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, sketch binary")


def _ones(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return POPCOUNT[x ^ y].sum(-1, dtype=np.int64)


def _found(a, b, group=None, blocks=None, load=None) -> pa.RecordBatch:
    """Rows of ``FOUND``: links, or (without ``b``) loose members of a group."""
    none = lambda kind: pa.nulls(len(a), kind)
    last = [none(k) if x is None else pa.array(x, k) for x, k in zip((group, blocks, load), (pa.int64(), pa.int32(), pa.float64()))]
    return pa.record_batch([pa.array(a, pa.int64()), none(pa.int64()) if b is None else pa.array(b, pa.int64()), *last], names=["a", "b", "group", "blocks", "load"])


def _sketches(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint16).reshape(table.num_rows, -1)


def sketch_links(x: np.ndarray, y: np.ndarray, limit: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place in x, place in y) of sketches that differ in at most ``limit`` bits; each once if x and y are the ``same``."""
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in range(len(x)):
        lo = i + 1 if same else 0
        j = lo + np.flatnonzero(_ones(x[i], y[lo:]) <= limit)
        a.append(np.full(len(j), i))
        b.append(j)
    return np.concatenate(a), np.concatenate(b)


def alike_by_sketch(limit: int):
    """Forests of the pairs whose sketches differ in at most ``limit`` bits, of each piece of a bucket; loose members of buckets of several blocks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, ["key", "i"]):
            ids, block, blocks, key = (table.column(c).to_numpy() for c in ("rep", "block", "blocks", "key"))
            sketch = _sketches(table)
            starts = run_starts(table, ["key", "i"])
            size = np.diff(starts)
            end = np.repeat(starts[1:], size)
            small = np.repeat((size <= 32) & (blocks[starts[:-1]] == 1), size)
            a, b = [], []
            for d in range(1, int(min(size.max(initial=0), 32))):  # small buckets, all at once
                x = np.flatnonzero(small & (np.arange(len(ids)) + d < end))
                x = x[_ones(sketch[x], sketch[x + d]) <= limit]
                a.append(x)
                b.append(x + d)
            for s, e in zip(starts[:-1], starts[1:]):
                if small[s]:
                    continue
                x, y = sketch_links(sketch[s:e], sketch[s:e], limit, same=True)
                if blocks[s] == 1:
                    x, y = forest(e - s, x, y)
                else:
                    x, y, loose = beside_hub(block[s:e] == 0, x, y)
                    if loose.any():
                        yield _found(ids[s:e][loose], None, key[s:e][loose], blocks[s:e][loose], np.full(loose.sum(), 1 / BUCKET_BLOCK))
                a.append(x + s)
                b.append(y + s)
            if a:
                a, b = forest(len(ids), np.concatenate(a), np.concatenate(b))
                if len(a):
                    yield _found(ids[a], ids[b])

    return work


def loose_by_sketch(limit: int):
    """The same of loose members (side 0) and all (side 1)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, ["key", "i", "j"]):
            ids, side, sketch = table.column("rep").to_numpy(), table.column("side").to_numpy(), _sketches(table)
            starts = run_starts(table, ["key", "i", "j"])
            for s, e in zip(starts[:-1], starts[1:]):
                mid = s + int(np.searchsorted(side[s:e], 1))
                x, y = sketch_links(sketch[s:mid], sketch[mid:e], limit, same=False)
                x, y = forest(e - s, x, y + mid - s)
                yield _found(ids[s + x], ids[s + y])

    return work


def full_sets(words: int):
    """(component, doc_id, blocks, shingles) of texts; the set as bytes of sorted 64-bit hashes."""
    keep = ["component", "doc_id", "blocks"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in text_chunks(batch, "text"):
                row, value = shingles(data, off, words)
                at = np.searchsorted(row, np.arange(hi - lo + 1))
                sets = [value[x:y].tobytes() for x, y in zip(at[:-1], at[1:])]
                yield pa.record_batch([*(batch.column(c).slice(lo, hi - lo) for c in keep), pa.array(sets, pa.binary())], names=[*keep, "shingles"])

    return work


def linked(sets: list[np.ndarray], side: np.ndarray | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets at or above the similarity; of different sides only, if sides are given."""
    size = np.array([len(s) for s in sets], np.int64)
    value, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    new = np.r_[True, value[1:] != value[:-1]]
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    owner, column = owner[shared], column[shared]
    column = np.cumsum(np.r_[True, column[1:] != column[:-1]]) - 1 if len(column) else column
    common = np.zeros((len(sets), len(sets)), np.int64)
    width = 4096
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        x, y = np.searchsorted(column, [lo, lo + width])
        has = np.zeros((len(sets), width), np.float32)
        has[owner[x:y], column[x:y] - lo] = 1
        common += (has @ has.T).astype(np.int64)
    ok = 100 * common >= percent * (size[:, None] + size[None, :] - common)
    if side is not None:
        ok &= side[:, None] != side[None, :]
    return np.nonzero(np.triu(ok, 1))


def _sets(table: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]


def confirmed(percent: int):
    """Forests of the links in each piece of a component; loose members of components of several blocks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["component", "i"]
        for table in whole_runs(batches, keys):
            ids, block, blocks, component = (table.column(c).to_numpy() for c in ("doc_id", "block", "blocks", "component"))
            sets = _sets(table)
            starts = run_starts(table, keys)
            for s, e in zip(starts[:-1], starts[1:]):
                x, y = linked(sets[s:e], None, percent)
                if blocks[s] == 1:
                    x, y = forest(e - s, x, y)
                else:
                    x, y, loose = beside_hub(block[s:e] == 0, x, y)
                    if loose.any():
                        load = [1 / SET_BLOCK + len(sets[s + i]) / SET_BLOCK_SHINGLES for i in np.flatnonzero(loose)]
                        yield _found(ids[s:e][loose], None, component[s:e][loose], blocks[s:e][loose], load)
                if len(x):
                    yield _found(ids[x + s], ids[y + s])

    return work


def loose_confirmed(percent: int):
    """The same of loose members (side 0) and all (side 1)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["component", "i", "j"]
        for table in whole_runs(batches, keys):
            ids, side, sets = table.column("doc_id").to_numpy(), table.column("side").to_numpy(), _sets(table)
            starts = run_starts(table, keys)
            for s, e in zip(starts[:-1], starts[1:]):
                x, y = forest(e - s, *linked(sets[s:e], side[s:e], percent))
                yield _found(ids[x + s], ids[y + s])

    return work


def links_of_groups(rows: DataFrame, group: str, member: str, compare, compare_loose, name: str) -> DataFrame:
    """Links (a, b) that connect what is linked within the groups of ``rows`` (group, member, blocks and what is compared).

    Blocks are compared with themselves and the hub; members that this does not connect
    with the hub's largest component are compared with all.
    """
    first = written(to_hub(rows, [group], F.col("blocks"), member).mapInArrow(compare, FOUND), name)
    links, loose = first.where("b IS NOT NULL").select("a", "b"), first.where("b IS NULL")
    if loose.isEmpty():
        return links
    held = loose.groupBy(F.col("group").alias(group)).agg(F.ceil(F.sum("load")).cast("int").alias("loose_blocks"))
    named = loose.select(F.col("group").alias(group), F.col("a").alias(member), F.lit(True).alias("loose")).distinct()
    marked = rows.join(held, group).join(named, [group, member], "left")
    dealt = loose_to_all(marked, [group], F.col("blocks"), F.col("loose_blocks"), F.coalesce("loose", F.lit(False)), member)
    return links.unionByName(dealt.mapInArrow(compare_loose, FOUND).select("a", "b"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``."""
    marks = written(signatures(docs, words, percent), "minhash")
    classes = written(marks.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_a", "set_b", "n_shingles")
                      .agg(F.min("doc_id").alias("rep"), F.min_by(F.struct("bands", "sketch"), "doc_id").alias("s"))
                      .select("set_a", "set_b", "n_shingles", "rep", "s.bands", "s.sketch"), "minhash-classes")
    keys = classes.select("rep", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").count().where("count > 1").select("key", F.ceil(F.col("count") / BUCKET_BLOCK).cast("int").alias("blocks"))
    limit = sketch_limit(percent)
    alike = links_of_groups(keys.join(buckets, "key").join(classes.select("rep", "sketch"), "rep"), "key", "rep", alike_by_sketch(limit), loose_by_sketch(limit), "minhash-alike")
    close = connected_components(alike, "minhash-close").withColumnRenamed("id", "doc_id")
    held = close.join(classes.select(F.col("rep").alias("doc_id"), "n_shingles"), "doc_id").groupBy("component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("total"))
    need = F.greatest(F.ceil(F.col("n") / SET_BLOCK), F.ceil(F.col("total") / SET_BLOCK_SHINGLES)).cast("int").alias("blocks")
    close = written(close.join(held.select("component", need), "component"), "minhash-close")
    texts = docs.select("doc_id", "text").join(close, "doc_id").select("component", "doc_id", "blocks", "text")
    sets = written(texts.mapInArrow(full_sets(words), "component long, doc_id long, blocks int, shingles binary"), "minhash-sets")
    links = links_of_groups(sets, "component", "doc_id", confirmed(percent), loose_confirmed(percent), "minhash-confirmed")
    found = connected_components(links, "minhash-links")
    groups = written(classes.select("set_a", "set_b", "n_shingles", "rep").join(found.withColumnRenamed("id", "rep"), "rep", "left")
                     .select("set_a", "set_b", "n_shingles", F.coalesce("component", "rep").alias("component")), "minhash-groups")
    named = marks.select("doc_id", "n_shingles", "set_a", "set_b").join(groups, ["set_a", "set_b", "n_shingles"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return named.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def without_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, one document of each group, with all their columns."""
    dropped = near_duplicates(docs, words, percent).where("not kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
