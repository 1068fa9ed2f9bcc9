"""Order-sensitive operators that must not run as one global single-partition window.

``dense_surrogate_key``  IDENTITY(1,1)-style dense keys 1..N in business-key order.
``ntile_global``         NTILE(k) over a global order, per row.
``ntile_histogram``      NTILE(k) bucket sizes and value sums from a value histogram.

How the global order is kept without one partition: a small sorted sample of the key
gives split points; every row gets ``b`` = number of split points <= its key (a
binary-search CASE tree over literals, so ``b`` is a pure function of the key and is
recomputed identically after an executor loss).  ``b`` preserves order, so the rank of a
row is (rows in buckets before ``b``) + (row_number inside ``b``).  The per-bucket counts
are a tiny aggregate (one row per bucket); their prefix sums are embedded as an array
literal.  Sampling only affects balance, never the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets for each shuffle partition and sampled keys for each bucket: several small buckets
# a partition even out what the sample gets wrong.
_BUCKETS_PER_PARTITION = 4
_OVERSAMPLE = 16


def _order_cols(cols: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in cols]


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def split_points(source: DataFrame, cols: list[str], n_buckets: int, seed: int = 17,
                 total: int | None = None) -> list[tuple]:
    """Up to ``n_buckets - 1`` sorted, distinct split keys from a random sample.

    About 16 keys a bucket are drawn, whatever the table size; all of them count, so the
    split points lie evenly even if the sample is larger than expected.
    """
    if n_buckets <= 1:
        return []
    src = source.select(*cols)
    total = src.count() if total is None else total
    if total == 0:
        return []
    target = n_buckets * _OVERSAMPLE
    frac = min(1.0, target / total)
    # some 16 keys a bucket: sorted in one small task, as a global sort would draw them twice
    sample = (src.sample(withReplacement=False, fraction=frac, seed=seed)
              .repartition(1).sortWithinPartitions(*_order_cols(cols)).collect())
    if not sample:
        return []
    step = len(sample) / n_buckets
    picks, seen = [], set()
    for i in range(1, n_buckets):
        row = tuple(sample[min(len(sample) - 1, int(i * step))])
        if any(v is None for v in row) or row in seen:
            continue
        seen.add(row)
        picks.append(row)
    return picks


def _key_and_literals(df: DataFrame, cols: list[str], splits: list[tuple]):
    types = {f.name: f.dataType for f in df.schema.fields}
    if len(cols) == 1:
        c = cols[0]
        return F.col(c), [F.lit(s[0]).cast(types[c]) for s in splits]
    key = F.struct(*[F.col(c).alias(c) for c in cols])
    lits = [F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(cols, s)]) for s in splits]
    return key, lits


def bucket_expr(df: DataFrame, cols: list[str], splits: list[tuple], key_col: str | None = None) -> Column:
    """Order-preserving bucket id 0..len(splits): number of split points <= key.

    A balanced CASE tree over the literals: O(log n) comparisons per row.  NULL keys
    (single-column) go to bucket 0, matching NULLS FIRST.  ``key_col`` names a column
    already holding ``struct(cols...)`` for composite keys.
    """
    if not splits:
        return F.lit(0)
    key, lits = _key_and_literals(df, cols, splits)
    if key_col is not None:
        key = F.col(key_col)

    def tree(lo: int, hi: int, k: Column) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2
        return F.when(k < lits[mid - 1], tree(lo, mid - 1, k)).otherwise(tree(mid, hi, k))

    # in a lambda: the key is built once a row, and the tree stays out of the generated method of
    # the scan, which the JVM would no longer compile (10 us a row instead of 1)
    expr = F.get(F.transform(F.array(key), lambda k: tree(0, len(splits), k)), 0)
    if len(cols) == 1:
        expr = F.when(F.col(cols[0]).isNull(), F.lit(0)).otherwise(expr)
    return expr


def dense_surrogate_key(df: DataFrame, order_by: list[str], name: str,
                        n_buckets: int | None = None, sample_from: DataFrame | None = None,
                        bucket_by: list[str] | None = None) -> DataFrame:
    """Add ``name`` = dense 1..N in the order of ``order_by`` (ascending, NULLS FIRST).

    Equals ``row_number() over (order by order_by...)``; rows that tie on every
    ``order_by`` column get consecutive numbers in an unspecified order.
    ``bucket_by`` (a prefix of ``order_by``, default all of it) is what the buckets are cut
    on; ``sample_from`` may name a cheaper relation holding those columns to draw split
    points from (for example the staging scan instead of a joined fact).
    Runs two small jobs (sample, per-bucket counts) plus the numbering itself; callers
    numbering an expensive plan should checkpoint it first.
    """
    return _number(df, order_by, name, n_buckets, sample_from, bucket_by)[0]


def _number(df: DataFrame, order_by: list[str], name: str, n_buckets: int | None,
            sample_from: DataFrame | None, bucket_by: list[str] | None = None) -> tuple[DataFrame, int]:
    bucket_by = bucket_by or order_by
    if order_by[:len(bucket_by)] != bucket_by:
        raise ValueError("bucket_by must be a prefix of order_by")
    source = sample_from if sample_from is not None else df
    source_rows = source.count()
    if n_buckets is None:
        n_buckets = _BUCKETS_PER_PARTITION * _partitions(df)
    splits = split_points(source, bucket_by, n_buckets, total=source_rows)
    b = "__rm_bucket"
    if len(bucket_by) > 1 and splits:
        # build the composite key once per row, not once per comparison of the CASE tree
        kc = "__rm_key"
        keyed = df.withColumn(kc, F.struct(*[F.col(c).alias(c) for c in bucket_by]))
        bucketed = keyed.withColumn(b, bucket_expr(keyed, bucket_by, splits, key_col=kc)).drop(kc)
    else:
        bucketed = df.withColumn(b, bucket_expr(df, bucket_by, splits))
    if splits:
        counts = {r[0]: r[1] for r in bucketed.groupBy(b).count().collect()}
    else:
        counts = {0: source_rows if sample_from is None else df.count()}
    offsets, run = [], 0
    for i in range(len(splits) + 1):
        offsets.append(run)
        run += counts.get(i, 0)
    offset = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]), F.col(b) + 1)
    # neighbouring buckets share a partition: hashing would put several on one and none on others,
    # and a range partitioning would read all columns of ``df`` once more to find its bounds
    at, n_at = "__rm_partition", min(len(splits) + 1, _partitions(df))
    w = Window.partitionBy(at, b).orderBy(*_order_cols(order_by))
    placed = bucketed.withColumn(at, F.call_function("div", F.col(b) * n_at, F.lit(len(splits) + 1)).cast("int"))
    placed = placed.repartitionById(n_at, F.col(at)) if splits else placed
    numbered = placed.withColumn(name, F.row_number().over(w).cast("long") + offset).drop(at, b)
    return numbered, run


def ntile_global(df: DataFrame, order_by: list[str], k: int, name: str,
                 n_buckets: int | None = None) -> DataFrame:
    """NTILE(k) over a global order, without a single-partition window.

    With T rows, q = T div k, m = T mod k: the first m tiles hold q+1 rows.
    """
    rn = "__rm_rn"
    numbered, t = _number(df, order_by, rn, n_buckets, None)
    q, m = divmod(t, k)
    big = m * (q + 1)
    r0 = F.col(rn) - 1
    tile = F.when(F.col(rn) <= big, F.call_function("div", r0, F.lit(q + 1)) + 1)
    if q > 0:
        tile = tile.otherwise(F.lit(m) + F.call_function("div", r0 - F.lit(big), F.lit(q)) + 1)
    return numbered.withColumn(name, tile.cast("long")).drop(rn)


def ntile_histogram(hist: DataFrame, value_col: str, count_col: str, k: int) -> DataFrame:
    """NTILE(k) over rows sorted by ``value_col``, given only the histogram (value, count).

    Returns (bucket, rows, value_sum).  Exact because rows that tie on the value are
    interchangeable for these outputs.  ``hist`` has one row per distinct value, so the
    single ordered window here runs over a small input.
    """
    w_all = Window.partitionBy()
    w_ord = Window.orderBy(F.col(value_col).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    h = (hist
         .withColumn("_t", F.sum(count_col).over(w_all))
         .withColumn("_start", F.coalesce(F.sum(count_col).over(w_ord), F.lit(0)))
         .withColumn("_end", F.col("_start") + F.col(count_col) - 1)
         .withColumn("_q", F.call_function("div", F.col("_t"), F.lit(k)))
         .withColumn("_m", F.col("_t") % k)
         .withColumn("_big", F.col("_m") * (F.col("_q") + 1)))

    def tile_of(pos: Column) -> Column:
        return F.when(pos < F.col("_big"), F.call_function("div", pos, F.col("_q") + 1)) \
            .otherwise(F.col("_m") + F.call_function("div", pos - F.col("_big"), F.greatest(F.col("_q"), F.lit(1))))

    def tile_start(b: Column) -> Column:
        return F.when(b < F.col("_m"), b * (F.col("_q") + 1)) \
            .otherwise(F.col("_big") + (b - F.col("_m")) * F.col("_q"))

    def tile_end(b: Column) -> Column:
        return tile_start(b + 1) - 1

    pieces = (h.withColumn("_b", F.explode(F.sequence(tile_of(F.col("_start")), tile_of(F.col("_end")))))
              .withColumn("_n", F.least(F.col("_end"), tile_end(F.col("_b")))
                          - F.greatest(F.col("_start"), tile_start(F.col("_b"))) + 1))
    return (pieces.groupBy((F.col("_b") + 1).alias("bucket"))
            .agg(F.sum("_n").cast("long").alias("rows"),
                 F.sum(F.col("_n") * F.col(value_col)).cast("long").alias("value_sum")))
