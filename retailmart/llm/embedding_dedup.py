"""Near-duplicate embeddings by random projection passes.

In each pass vectors are grouped by label and the leading signs of their projections on
random hyperplanes; all vectors of a group (a run) are compared, cosine in double precision,
and verified pairs are united over all passes.  A pair meets in a pass if it agrees in the
leading signs, so depth (signs that count) and limit alone give the number of passes after
which a pair at the limit has met with probability 0.999, however the vectors are spread.

The depth follows the density measured in one projection: a label takes the depth at which
its passes cost the fewest comparisons, where cutting runs below ``window`` gains nothing.
Spread vectors need few signs; a dense label, which signs hardly cut, ends at few signs and
few passes over large runs, a small one at no sign and a single pass.  Runs larger than a
block are compared in pairs of blocks, so none is cut off or ends in one task.

The links of every vector are then counted against its whole component, in pairs of blocks.
Only forests and counts leave a task.

Defined results: vectors that are null, empty, zero or hold null, NaN or infinite
components, and rows without a label or vec_id, link with nothing; vectors of different
lengths are never compared; equal vectors of a label link with each other (their cosine is
1) and go on as one class; rows that repeat a vec_id count as copies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forest, in_blocks, run_starts, whole_runs, written
from .components import connected_components

SIGNS = 48
WINDOW = 64
DEPTHS = range(0, SIGNS + 1, 3)
RUN_BLOCK = 1024
BLOCK = 512
RUN = ["turn", "dim", "label", "key"]


def passes_for(depth: int, limit: float, missed: float = 1e-3) -> int:
    """Passes after which a pair at the limit has agreed in ``depth`` signs, but for ``missed``."""
    hit = (1 - math.acos(limit) / math.pi) ** depth
    return 1 if hit >= 1 - missed else math.ceil(math.log(missed) / math.log(1 - hit))


def matrix(vectors: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Unit rows, in double precision, of lists of one length."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    flat = np.asarray(vectors.flatten(), np.float64).reshape(len(vectors), -1)
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def hyperplanes(turn: int, dim: int) -> np.ndarray:
    return np.random.default_rng((turn, dim)).standard_normal((dim, SIGNS))


def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each vector and pass: (turn, dim, label, key, rep); the key holds the leading ``depth`` signs."""
    weight = np.int64(1) << np.arange(SIGNS - 1, -1, -1)
    for batch in batches:
        lengths, passes = batch.column("dim").to_numpy(), batch.column("passes").to_numpy()
        for dim in np.unique(lengths):
            for turn in range(int(passes[lengths == dim].max())):
                part = batch.filter(pa.array((lengths == dim) & (passes > turn)))
                key = (matrix(part.column("vector")) @ hyperplanes(turn, int(dim)) > 0) @ weight
                key >>= SIGNS - part.column("depth").to_numpy().astype(np.int64)
                yield pa.record_batch([pa.array(np.full(len(key), turn, np.int32)), part.column("dim"), part.column("label"), pa.array(key), part.column("rep")],
                                      names=["turn", "dim", "label", "key", "rep"])


def depths(classes: DataFrame, strings: str, limit: float, window: int) -> DataFrame:
    """(dim, label, depth, passes): of the depths, the one with the fewest comparisons by the runs of one projection."""
    signs = classes.withColumn("depth", F.lit(SIGNS)).withColumn("passes", F.lit(1)).mapInArrow(projected, strings)
    runs = signs.groupBy("dim", "label", "key").agg(F.count("*").alias("n")).withColumn("depth", F.explode(F.array(*[F.lit(x) for x in DEPTHS])))
    runs = runs.groupBy("dim", "label", "depth", F.expr(f"shiftright(key, {SIGNS} - depth)").alias("key")).agg(F.sum("n").alias("n"))
    passes = F.element_at(F.create_map(*[F.lit(x) for d in DEPTHS for x in (d, passes_for(d, limit))]), F.col("depth"))
    pairs = runs.groupBy("dim", "label", "depth").agg(F.sum(F.col("n").cast("double") * F.greatest("n", F.lit(window))).alias("pairs")).withColumn("passes", passes)
    best = pairs.groupBy("dim", "label").agg(F.min(F.struct(F.col("pairs") * F.col("passes"), "depth", "passes")).alias("best"))
    return best.select("dim", "label", "best.depth", "best.passes")


def in_runs(limit: float):
    """Forests of the pairs that reach the limit, of each pair of a run's blocks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = [*RUN, "i", "j"]
        for table in whole_runs(batches, keys):
            starts = run_starts(table, keys)
            rep = table.column("rep").to_numpy()
            block, i, j = (table.column(c).to_numpy() for c in ("block", "i", "j"))
            found = []
            for s, e in zip(starts[:-1], starts[1:]):
                if e - s < 2:
                    continue
                x = matrix(table.column("vector").slice(s, e - s))
                near = np.triu(x @ x.T >= limit, 1)
                if i[s] != j[s]:
                    near &= block[s:e, None] != block[None, s:e]
                a, b = forest(e - s, *np.nonzero(near))
                found.append((rep[s + a], rep[s + b]))
            if found:
                yield pa.record_batch([pa.array(np.concatenate(x)) for x in zip(*found)], names=["a", "b"])

    return work


def counted(limit: float):
    """(rep, links) within a pair of blocks of a component: copies of the other classes that reach the limit."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["component", "i", "j"]
        for table in whole_runs(batches, keys):
            starts = run_starts(table, keys)
            rep, copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
            block, i, j = (table.column(c).to_numpy() for c in ("block", "i", "j"))
            links = np.zeros(len(rep), np.int64)
            for s, e in zip(starts[:-1], starts[1:]):
                x = matrix(table.column("vector").slice(s, e - s))
                near = x @ x.T >= limit
                if i[s] == j[s]:
                    np.fill_diagonal(near, False)
                else:
                    near &= block[s:e, None] != block[None, s:e]
                links[s:e] = near @ copies[s:e]
            yield pa.record_batch([pa.array(rep), pa.array(links)], names=["rep", "links"])

    return work


def near_duplicate_vectors(rows: DataFrame, limit: float = 0.98, window: int = WINDOW) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding, label)."""
    rows = rows.select("vec_id", F.col("embedding").alias("vector"), "label")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    good = rows.where(usable)
    classes = written(good.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
                      .select("label", F.size("vector").alias("dim"), "vector", "rep", "copies"), "vector-classes")
    strings = f"turn int, dim int, label {dict(classes.dtypes)['label']}, key long, rep long"
    plan = written(depths(classes, strings, limit, window), "vector-depths")
    keys = written(classes.join(plan, ["dim", "label"]).select("dim", "label", "rep", "vector", "depth", "passes").mapInArrow(projected, strings), "vector-keys")
    runs = keys.groupBy(*RUN).agg(F.count("*").alias("n")).where("n > 1")
    met = keys.join(runs, RUN).join(classes.select("rep", "vector"), "rep")
    dealt = in_blocks(met, RUN, F.ceil(F.col("n") / RUN_BLOCK), "rep").select(*RUN, "i", "j", "block", "rep", "vector")
    components = connected_components(dealt.mapInArrow(in_runs(limit), "a long, b long"), "vector-links")
    held = components.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    members = (components.withColumnRenamed("id", "rep").join(classes.select("rep", "vector", "copies"), "rep").join(held, "component"))
    blocks = in_blocks(members, ["component"], F.col("blocks"), "rep").select("component", "i", "j", "block", "rep", "copies", "vector")
    links = blocks.mapInArrow(counted(limit), "rep long, links long").groupBy("rep").agg(F.sum("links").alias("links"))
    known = written(classes.join(components.withColumnRenamed("id", "rep"), "rep", "left").join(links, "rep", "left")
                    .select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component")), "vector-groups")
    found = (good.join(known, ["label", "vector"]).select("vec_id", "n_links", F.col("component").alias("component_id")))
    rest = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
