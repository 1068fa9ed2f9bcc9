"""Helpers shared by the operators: written intermediates, Arrow text buffers, sorted runs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

CHUNK_BYTES = 1 << 20
# odd multiplier of the polynomial hashes and its inverse modulo 2**64
BASE = np.uint64(0x9E3779B97F4A7C15)
UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read again.

    Small row groups bound what a writing task buffers.  Cuts the lineage: executors lost later cost a read of this table, not its computation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("parquet.block.size", 16 << 20).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is referred to."""
    return F.element_at(F.transform(F.array(value), use), 1)


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    large = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if col.null_count:
        col = pc.fill_null(col, "" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64 if large else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def text_chunks(batch: pa.RecordBatch, col: str, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of slices of about ``most`` bytes and whole rows."""
    data, off = utf8(batch.column(col))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (xor-shift and multiply) over uint64 values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sorted_order(key: np.ndarray) -> np.ndarray:
    """Stable sorting order of uint64 keys (fewer than 2**32).

    Sorts 32 bits of the key with the place below them, low half first; numpy sorts values
    many times faster than it sorts places by value.
    """
    place, low = np.arange(len(key), dtype=np.uint64), np.uint64(0xFFFFFFFF)
    x = key << np.uint64(32)
    x |= place
    x.sort()
    x &= low
    order = x.view(np.int64)
    y = key[order]
    y &= ~low
    y |= place
    y.sort()
    y &= low
    return order[y.view(np.int64)]


class Rolling:
    """Polynomial hashes of any substrings of a byte buffer, modulo 2**64."""

    _pow = np.ones(1, np.uint64)
    _inv = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(Rolling._pow) < n:
            size = max(n, CHUNK_BYTES + 1)
            Rolling._pow = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, BASE)])
            Rolling._inv = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, UNBASE)])
        self.sums = np.zeros(n, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * Rolling._pow[:n - 1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * Rolling._inv[start] + (end - start).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k bytes from every position that has them."""
        if len(self.sums) <= k:
            return np.zeros(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:-k]) * Rolling._inv[:len(self.sums) - k])


SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the runs of bytes other than ASCII white space, within rows."""
    word = ~SPACES[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[off] = True
    before = np.r_[False, word[:-1]] if len(word) else word
    after = np.r_[word[1:], False] if len(word) else word
    start = np.flatnonzero(word & (~before | cut[:-1]))
    end = np.flatnonzero(word & (~after | cut[1:])) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


def whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole runs of equal ``keys`` from a partition sorted by them.

    Only the run that a batch ends with is held back, so memory follows the batch and the
    largest run.
    """
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        change = np.zeros(table.num_rows, bool)
        for k in keys:
            v = table.column(k).to_numpy()
            change[1:] |= v[1:] != v[:-1]
        if held:
            last = held[-1].slice(held[-1].num_rows - 1)
            change[0] = any(last.column(k)[0].as_py() != table.column(k)[0].as_py() for k in keys)
        starts = np.flatnonzero(change)
        if not len(starts):
            held.append(table)
            continue
        cut = int(starts[-1])
        if cut or held:
            yield pa.concat_tables([*held, table.slice(0, cut)]).combine_chunks()
        held = [table.slice(cut)]
    if held:
        yield pa.concat_tables(held).combine_chunks()


def run_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """First row of every run of equal keys, and the number of rows at the end."""
    change = np.ones(table.num_rows, bool)
    change[1:] = False
    for k in keys:
        v = table.column(k).to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.r_[np.flatnonzero(change), table.num_rows]


def joined(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the links (a, b) among ``n`` elements, some that keep all that is connected connected; and every element's smallest connected one.

    In each round every set but the smallest of those linked hooks onto one with a smaller
    root; fewer than ``n`` links are kept.
    """
    parent, kept = np.arange(n), []
    while len(a):
        ra, rb = parent[a], parent[b]
        live = ra != rb
        a, b, ra, rb = a[live], b[live], ra[live], rb[live]
        if not len(a):
            break
        high, first = np.unique(np.maximum(ra, rb), return_index=True)
        kept.append((a[first], b[first]))
        parent[high] = np.minimum(ra, rb)[first]
        while not np.array_equal(up := parent[parent], parent):
            parent = up
    if not kept:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), parent
    return np.concatenate([x for x, _ in kept]), np.concatenate([x for _, x in kept]), parent


def forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links that ``joined`` keeps."""
    return joined(n, a, b)[:2]


def beside_hub(hub: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links to keep of a piece dealt by ``to_hub``, and which members stay loose.

    A member is settled if the piece connects it with the largest component that the hub
    has by its own links.  All pieces of a group hold the same hub, so they agree on that
    component and all settled members are connected; a link between two of them adds nothing.
    """
    n, inner = len(hub), hub[a] & hub[b]
    ia, ib, root = joined(n, a[inner], b[inner])
    if not hub.any():
        return *forest(n, a, b), np.ones(n, bool)
    main = int(np.argmax(np.bincount(root[hub])))
    if hub.all():
        return ia, ib, root != main
    oa, ob = forest(n, a[~inner], b[~inner])
    root = joined(n, np.r_[ia, oa], np.r_[ib, ob])[2]
    return oa, ob, ~hub & (root != root[main])


def in_blocks(rows: DataFrame, group: list[str], blocks: Column, member: str) -> DataFrame:
    """Rows dealt to the pairs of blocks of their group: columns ``block``, ``i`` and ``j``.

    A group has ``blocks`` blocks; a member belongs to one by hash and is sent to every pair
    that has it, so any two members of a group meet in exactly one pair (two of one block in
    the pair of it with itself) and no task holds more than two blocks.
    """
    own = F.pmod(F.xxhash64(member), blocks).cast("int")
    dealt = rows.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))
    dealt = dealt.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other")
    return dealt.repartition(shuffle_partitions(rows), *group, "i", "j").sortWithinPartitions(*group, "i", "j", member)


def to_hub(rows: DataFrame, group: list[str], blocks: Column, member: str) -> DataFrame:
    """Rows dealt to the blocks of their group, each beside the hub: columns ``block`` and ``i``.

    A member belongs to one block by hash.  Block 0 is the hub and is sent to all blocks, so
    a group is shuffled about twice, whatever its size, and no task holds more than two blocks.
    """
    own = F.pmod(F.xxhash64(member), blocks).cast("int")
    pieces = F.when(F.col("block") == 0, F.sequence(F.lit(0), (blocks - 1).cast("int"))).otherwise(F.array("block"))
    dealt = rows.withColumn("block", own).withColumn("i", F.explode(pieces))
    return dealt.repartition(shuffle_partitions(rows), *group, "i").sortWithinPartitions(*group, "i", member)


def loose_to_all(rows: DataFrame, group: list[str], blocks: Column, loose_blocks: Column, loose: Column, member: str) -> DataFrame:
    """Rows dealt so that every loose member meets every member of its group: columns ``side``, ``i`` and ``j``.

    All members (side 1) go to each block of loose ones, the loose ones (side 0) also to
    each block of all; a loose member meets itself too.
    """
    own, own_loose = F.pmod(F.xxhash64(member), blocks).cast("int"), F.pmod(F.xxhash64(member), loose_blocks).cast("int")
    spot = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), F.lit(side).alias("side"))
    every = F.transform(F.sequence(F.lit(0), (loose_blocks - 1).cast("int")), lambda j: spot(own, j, 1))
    more = F.transform(F.sequence(F.lit(0), (blocks - 1).cast("int")), lambda i: spot(i, own_loose, 0))
    dealt = rows.withColumn("spot", F.explode(F.when(loose, F.concat(every, more)).otherwise(every))).select(*rows.columns, "spot.*")
    return dealt.repartition(shuffle_partitions(rows), *group, "i", "j").sortWithinPartitions(*group, "i", "j", "side", member)
