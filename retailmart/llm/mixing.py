"""Mixing sources to target weights (DataFrame operations only).

Every source gets a word budget: the sources share the corpus by weight, no source is
repeated more than ``max_epochs`` times, and what a capped source leaves is shared by
weight among the others.  A budget of e.g. 2.3 times the source takes every document
twice (complete epochs come first) and then a weighted random part of 0.3: documents are
ordered by the Efraimidis-Spirakis key ``-ln(u) / quality`` (an exponential variable whose
rate is the document's quality) and taken while the running sum of words stays within the
budget; the document on the edge is taken if that comes nearer to the budget.

The running sum needs no global sort.  The key is mapped to a 48-bit position that keeps
its order, and the edge is found by radix descent: word sums by source and leading byte
(combined before the shuffle) tell in which byte range the budget runs out, then the next
byte is looked at within that range, until at most ``edge_rows`` rows of any source are
in it.  Only those are sorted.  A source with a third of all rows is thus spread like any
other.

Defined results: a null text has no words; a null source is a source of its own and the
last; rows that agree in key and doc_id are ordered arbitrarily, with equal results; an
empty table gives an empty mix; a row without doc_id draws a key as the text '' would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BITS = 48


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def prose_quality(text: Column) -> Column:
    """0.05 to 1.05: the share of letters and white space, plus a floor."""
    other = F.length(text) - F.length(F.regexp_replace(text, r"[^\p{L}\x20\x09-\x0D]+", ""))
    return F.coalesce(1.05 - other / F.greatest(F.length(text), F.lit(1)), F.lit(1.05))


def uniform(doc_id: Column, seed: str) -> Column:
    """A number above 0 and below 1 that depends on the id and the seed only."""
    hexed = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13)
    return (F.conv(hexed, 16, 10).cast("double") + 1) / float(2**52 + 2)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.0, max_epochs: float = 3.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size); one row a source.

    Sources are weighted in code point order, null last, the weights repeating.  The
    windows run over the table of sources, not of documents.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((rank - 1) % len(weights) + 1).cast("int"))
    caps = sizes.select("source", "source_size", w.alias("w"), rank.alias("rank")).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    by_cap = Window.orderBy((F.col("cap") / F.col("w")), "rank")
    total = F.sum("source_size").over(Window.partitionBy())
    level = ((F.lit(float(share)) * total - F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
             / F.sum("w").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
    levels = caps.withColumn("level", level).withColumn("place", F.row_number().over(by_cap))
    whole = Window.partitionBy()
    first = F.min(F.when(F.col("level") <= F.col("cap") / F.col("w"), F.struct("place", "level"))).over(whole)
    return levels.select("source", "source_size", F.least(F.col("cap"), F.coalesce(first["level"] * F.col("w"), F.col("cap"))).alias("target"))


def mix_sources(docs: DataFrame, weights=WEIGHTS, share: float = 1.0, max_epochs: float = 3.0, seed: str = "mix",
                quality=prose_quality, edge_rows: int = 20_000) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) of every row of ``docs``.

    ``copies`` is how often the mix takes the document, ``taken`` the words that gives.
    """
    text = F.col("text")
    base = docs.select("doc_id", "source", n_words(text).alias("size"), (-F.log(uniform(F.col("doc_id"), seed)) / quality(text)).alias("key"))
    # keys are near exponential with the mean quality's rate; the scale spreads positions evenly
    pos = F.floor((1 - F.exp(-F.col("key"))) * F.lit(float(2**BITS))).cast("long")
    base = written(base.withColumn("pos", F.least(pos, F.lit(2**BITS - 1))), "mix-rows")
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = (source_targets(sizes, weights, share, max_epochs).withColumn("epochs", epochs)
             .withColumn("need", F.col("target") - F.col("epochs") * F.col("source_size"))
             .withColumn("prefix", F.when(F.col("need") > 0, F.lit(0)).cast("long"))
             .withColumn("before", F.lit(0).cast("long")))
    state = written(state, "mix-state")
    for shift in range(BITS - 8, -1, -8):
        state = written(_descend(base, state, shift), "mix-state")
        edge = F.shiftright("pos", shift) == F.col("prefix")
        most = _with_state(base, state).where(edge).groupBy("source").count().agg(F.max("count")).first()[0]
        if (most or 0) <= edge_rows:
            break
    leading = F.shiftright(F.col("pos"), shift)
    rows = _with_state(base, state).withColumn("edge", F.coalesce(leading == F.col("prefix"), F.lit(False)))
    order = Window.partitionBy("source").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    edges = rows.where("edge").withColumn("sum", F.col("before") + F.sum("size").over(order))
    picked = edges.withColumn("part", F.col("sum") - F.col("size") / 2.0 < F.col("need")).drop("sum")
    others = rows.where("not edge").withColumn("part", F.coalesce(leading < F.col("prefix"), F.lit(False)))
    copies = F.col("epochs") + F.col("part").cast("long")
    return (others.unionByName(picked).withColumn("copies", copies)
            .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")))


def _with_state(base: DataFrame, state: DataFrame) -> DataFrame:
    renamed = state.withColumnRenamed("source", "of")
    return base.join(renamed, F.col("source").eqNullSafe(F.col("of"))).drop("of")


def _descend(base: DataFrame, state: DataFrame, shift: int) -> DataFrame:
    """``state`` with the prefix one byte longer: where the budget of each source runs out.

    ``prefix`` is null for a source that has no fraction to take.
    """
    at = F.shiftright("pos", shift)
    parts = (_with_state(base, state).where(F.shiftright("pos", shift + 8) == F.col("prefix"))
             .groupBy("source", at.alias("at")).agg(F.sum("size").alias("words")))
    up_to = Window.partitionBy("source").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    ends = parts.withColumn("end", F.sum("words").over(up_to)).withColumnRenamed("source", "of")
    found = (ends.join(state.select(F.col("source").alias("s"), "need", "before"), F.col("of").eqNullSafe(F.col("s")))
             .withColumn("reached", F.col("before") + F.col("end") >= F.col("need"))
             .groupBy("of").agg(F.min(F.when(F.col("reached"), F.struct("at", (F.col("before") + F.col("end") - F.col("words")).alias("b")))).alias("hit"),
                                F.max("at").alias("last")))
    # where rounding leaves the sum just short of the need, everything is taken
    prefix = F.coalesce(F.col("hit.at"), F.col("last") + 1)
    return (state.join(found, F.col("source").eqNullSafe(F.col("of")), "left")
            .select("source", "source_size", "target", "epochs", "need", prefix.alias("prefix"), F.coalesce("hit.b", "before").alias("before")))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it (not at all where 0)."""
    plan = mix_sources(docs, **options).select("doc_id", "source", "copies").where("copies > 0")
    plan = plan.groupBy(F.col("doc_id").alias("__id"), F.col("source").alias("__source")).agg(F.max("copies").alias("__copies"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__source"))
    return docs.join(plan, same).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)
