"""Benchmark decontamination by winnowing (DataFrame operations only).

A window is ``length`` consecutive words of a benchmark item (all words of a shorter item).
A document word inside any occurrence of a window is hit.

1. Winnowing.  Every window of a document has a fingerprint, the smallest hash of the
   word k-grams in it; neighbouring windows mostly share theirs, so a run of windows with
   one fingerprint is kept as one row: the hash, where the run starts and its words.  A
   span of ``length`` words that both sides have contains the same k-grams on both, hence
   the same smallest hash: no such span is missed.  A shorter benchmark item is looked
   for with windows of its own length.
2. The runs meet the fingerprints of the benchmark (a semi join: a fingerprint that many
   items have multiplies nothing).  Before that a sieve, a bitmap of those fingerprints,
   spares making rows of most runs that will meet none.
3. Hits are extended: the windows of a run that met are compared, word for word, with the
   distinct windows of the benchmark.  The words go along with the fingerprint, so no
   document is moved or joined again.
4. The windows found in a document are united to spans.  Which items they stand for is
   looked up once for each distinct set of windows, so a passage that very many documents
   and items share is not expanded to all pairs of them.

The benchmark side is broadcast up to ``BROADCAST_BYTES``; beyond, the joins shuffle and
adaptive execution splits a hot key.

Defined results: null text has no words; rows with equal doc_id and text (null ids too)
have the same result, rows that share a doc_id but not the text each their own; an item on
several rows holds the windows of all; windows of rows without an item_id hit words but
count as no item; an empty benchmark hits nothing.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bound, written

LENGTH = 10
#: The words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of a lower-cased text, and of one as it is, as classes that Java matches fast.
WORD = r"[a-z0-9\P{ASCII}]+"
RAW_WORD = r"[a-zA-Z0-9\P{ASCII}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Benchmark windows that are broadcast, by the bytes of their text and keys.
BROADCAST_BYTES = 32 << 20
#: Low bits of a k-gram's key that tell its place (modulo 256), which keeps apart equal hashes of one window.
PLACE = 255
#: Elements (of 64 bits) of the sieve at most: a benchmark of any size has one, a very large one merely skips less.
SIEVE = 1 << 13
KEY = ["doc_id", "text_hash"]


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def gram(length: int) -> int:
    """Words of a k-gram for windows of ``length`` words: 4 for 10."""
    return (2 * length + 4) // 5


def keys(w: Column, length: int) -> Column:
    """Key of the k-gram from every word that has one: hash above, place below."""
    k = gram(length)

    def of(h: Column) -> Column:
        return F.transform(F.slice(h, 1, F.size(h) - (k - 1)), lambda x, i: F.xxhash64(x, *(F.get(h, i + j) for j in range(1, k)))
                           .bitwiseAND(F.lit(~PLACE)).bitwiseOR(i.bitwiseAND(F.lit(PLACE)).cast("long")))

    return bound(F.transform(w, lambda x: F.xxhash64(x)), of)


def smallest(k: Column, wide: int, n: Column) -> Column:
    """The smallest of ``wide`` keys from each of the first ``n`` places."""
    return F.transform(F.slice(k, 1, n), lambda x, i: F.least(x, x, *(F.get(k, i + j) for j in range(1, wide))))


def winnowed(w: Column, length: int, sieve: np.ndarray) -> Column:
    """Runs of windows with one fingerprint that passes the sieve: (first, windows, length, print, words) of each."""
    wide = length - gram(length) + 1

    def runs(least: Column) -> Column:
        starts = F.transform(least, lambda x, s: F.when(~F.get(least, s - 1).eqNullSafe(x) & _passes(sieve, F.shiftright(x, 8)), s))
        windows = lambda s: F.size(F.filter(F.slice(least, s + 1, F.lit(wide)), lambda x: x == F.get(least, s)))
        return F.transform(F.array_compact(starts), lambda s: bound(windows(s), lambda n: F.struct(
            s.alias("first"), n.alias("windows"), F.lit(length).alias("length"), F.shiftright(F.get(least, s), 8).alias("print"), F.slice(w, s + 1, n + (length - 1)).alias("words"))))

    found = bound(keys(w, length), lambda k: bound(smallest(k, wide, F.size(w) - (length - 1)), runs))
    none = F.array().cast("array<struct<first:int,windows:int,length:int,print:long,words:array<string>>>")
    return F.when(F.size(w) >= length, found).otherwise(none)


def _place(fingerprint: Column, size: int) -> tuple[Column, Column]:
    """The element of a sieve of ``size`` (a power of two) and the bit in it that stand for a fingerprint."""
    return fingerprint.bitwiseAND(F.lit(size - 1)).cast("int"), F.shiftright(fingerprint, 24).bitwiseAND(F.lit(63)).cast("int")


def _passes(sieve: np.ndarray, fingerprint: Column) -> Column:
    element, bit = _place(fingerprint, len(sieve))
    return F.getbit(F.get(F.lit(sieve), element), bit) == 1


def sieve_of(windows: DataFrame) -> np.ndarray:
    """A bitmap of the benchmark's fingerprints that lets most others be skipped; of ``SIEVE`` elements at most, however many there are."""
    size = min(SIEVE, 1 << max(6, windows.count().bit_length()))
    element, bit = _place(F.col("print"), size)
    set_bits = windows.groupBy(element.alias("element")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits")).collect()
    sieve = np.zeros(size, np.int64)
    for r in set_bits:
        sieve[r.element] = r.bits
    return sieve


def fingerprints(docs: DataFrame, lengths: list[int], sieve: np.ndarray) -> DataFrame:
    """(doc_id, text_hash, first, windows, length, print, words): the winnowed runs that pass the sieve, for windows of each length."""
    # the outer form: for the plain one Spark adds a filter that computes the runs a second time
    runs = bound(words(F.col("text")), lambda w: F.concat(*(winnowed(w, n, sieve) for n in lengths)))
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.explode_outer(runs).alias("run")).select(*KEY, "run.*")


def benchmark_windows(benchmark: DataFrame, length: int) -> DataFrame:
    """(item_id, length, window): the distinct windows of every item, as words joined by a space."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where("size(w) > 0").withColumn("length", F.least(F.lit(length), F.size("w")))
    every = F.transform(F.sequence(F.lit(1), F.size("w") - F.col("length") + 1), lambda s: F.array_join(F.slice(F.col("w"), s, F.col("length")), " "))
    return items.select("item_id", "length", F.explode(every).alias("window")).distinct()


def _distinct_windows(held: DataFrame, lengths: list[int]) -> DataFrame:
    """(length, window, print, wid)."""
    least = F.coalesce(*(F.when(F.col("length") == n, F.shiftright(F.array_min(keys(F.col("w"), n)), 8)) for n in lengths), F.lit(None).cast("long"))
    own = held.select("length", "window").distinct().withColumn("w", F.split("window", " "))
    return written(own.select("length", "window", least.alias("print"), F.monotonically_increasing_id().alias("wid")), "benchmark-prints")


def hits(docs: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """(doc_id, text_hash, start, length, wid): every occurrence of a benchmark window, word for word."""
    size = windows.agg(F.sum(F.octet_length("window") + 64)).first()[0] or 0
    side = F.broadcast if size <= BROADCAST_BYTES else lambda df: df
    met = fingerprints(docs, lengths, sieve_of(windows)).join(side(windows.select("length", "print").distinct()), ["length", "print"], "left_semi")
    every = F.transform(F.sequence(F.lit(0), F.col("windows") - 1),
                        lambda j: F.struct((F.col("first") + j).alias("start"), F.array_join(F.slice(F.col("words"), j + 1, F.col("length")), " ").alias("window")))
    apart = met.select(*KEY, "length", F.explode(every).alias("at")).select(*KEY, "length", "at.*")
    return apart.join(side(windows.select("length", "window", "wid")), ["length", "window"]).select(*KEY, "start", "length", "wid")


def spans(found: DataFrame) -> DataFrame:
    """(doc_id, text_hash, spans, n_hit, wids): the windows of a document united to maximal spans of words."""
    per = found.groupBy(*KEY).agg(F.collect_set(F.struct("start", "length", "wid")).alias("hits"))
    rows = per.select(*KEY, F.explode("hits").alias("hit")).select(*KEY, F.col("hit.start").alias("start"), F.expr("hit.start + hit.length").alias("end"), "hit.wid")
    order = Window.partitionBy(*KEY).orderBy("start", "end", "wid")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("new", F.coalesce(F.col("start") > reach, F.lit(True)).cast("int"))
    rows = rows.withColumn("span", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    each = rows.groupBy(*KEY, "span").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.collect_set("wid").alias("wids"))
    return each.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"), F.sum(F.col("end") - F.col("start")).alias("n_hit"),
                                  F.sort_array(F.array_distinct(F.flatten(F.collect_list("wids")))).alias("wids"))


def contamination(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_words, n_hit, spans, n_items, items, items_sha256, contaminated) of every row of ``docs``.

    ``spans`` are the maximal runs of hit words, (start, end) by word number; ``items`` the
    ids, as sorted strings, of the items with a window in the document.
    """
    held = written(benchmark_windows(benchmark, length), "benchmark-windows")
    lengths = sorted(r.length for r in held.select("length").distinct().collect())  # at most ``length`` numbers
    each = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce(F.regexp_count("text", F.lit(RAW_WORD)), F.lit(0)).cast("long").alias("n_words"))
    if lengths:
        windows = _distinct_windows(held, lengths)
        found = written(spans(hits(docs, windows, lengths)), "contaminated")
        holders = held.where("item_id IS NOT NULL").join(windows, ["length", "window"]).select("wid", F.col("item_id").cast("string").alias("item"))
        sets = (found.select("wids").distinct().select("wids", F.explode("wids").alias("wid")).join(holders, "wid")
                .groupBy("wids").agg(F.sort_array(F.collect_set("item")).alias("items")))
        sets = sets.select("wids", "items", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
        found = found.join(sets, "wids", "left").drop("wids")
    else:
        found = docs.sparkSession.createDataFrame([], "doc_id long, text_hash long, spans array<struct<start:int,end:int>>, n_hit long, items array<string>, n_items long, items_sha256 string")
    found = found.withColumnsRenamed({k: f"own_{k}" for k in KEY})
    both = each.join(found, F.col("doc_id").eqNullSafe(F.col("own_doc_id")) & (F.col("text_hash") == F.col("own_text_hash")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return both.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("spans", F.array().cast(found.schema["spans"].dataType)).alias("spans"),
                       F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                       F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
