"""Exact duplicates by content-defined chunk recipes (DataFrame operations only).

A text is normalised (runs of ASCII white space become one space) and cut into chunks
whose ends are chosen by the content, so equal passages give equal chunks wherever they
stand.  A chunk is named by a 64-bit hash; grouping the chunks themselves shows which
hashes stand for more than one chunk, and only those get a further number.  The ordered
list of chunk identifiers, the recipe, then stands for the text: equal texts have equal
recipes and different texts different ones, and only recipes are compared and moved.

Every chunk moves once, combined before the shuffle, so a chunk or a text that many
documents share costs one row a task.

Defined results: null counts as the empty text; rows without an id count in the group
and never stay if another row of it has one; a doc_id on several rows is one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

WHITE = r"[\x20\x09-\x0D]+"
#: A chunk ends before a space that stands between such letters (about one place in 250),
#: after 256 to 2048 characters; where no such place comes, after 2048.
CHUNK = r"(?s).{256,2048}?(?=[bdgkmpwy] [bcdfgjklmnp])|.{1,2048}"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def chunk_hash(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, body, chunks) of every row."""
    body = docs.select("doc_id", normalised(F.col("text")).alias("body"))
    return body.withColumn("chunks", F.regexp_extract_all("body", F.lit(CHUNK), F.lit(0)))


def clashes(cut: DataFrame, hash_of=chunk_hash) -> DataFrame:
    """(h): hashes that stand for more than one chunk, found by grouping the chunks themselves."""
    held = cut.select(F.explode("chunks").alias("chunk")).select(hash_of(F.col("chunk")).alias("h"), "chunk").distinct()
    return held.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")


def recipes(docs: DataFrame, hash_of=chunk_hash) -> DataFrame:
    """(doc_id, recipe, verbatim, text_sha256) of every row.

    ``recipe`` is the ordered list of chunk hashes.  Where one of them stands for several
    chunks, ``verbatim`` holds the chunks themselves, else it is empty; so two texts are
    equal exactly when both columns are.
    """
    cut = chunks(docs).withColumn("recipe", F.transform("chunks", hash_of))
    clash = written(clashes(cut, hash_of), "chunk-clashes")
    sha = F.sha2(F.col("body").cast("binary"), 256).alias("text_sha256")
    if clash.isEmpty():
        rows = cut.select("doc_id", "recipe", F.array().cast("array<string>").alias("verbatim"), sha)
    else:
        marked = (cut.select("recipe", F.explode("recipe").alias("h")).join(clash, "h")
                  .select("recipe", F.lit(True).alias("marked")).distinct())
        rows = (cut.join(marked, "recipe", "left")
                .select("doc_id", "recipe", F.when(F.col("marked"), F.col("chunks")).otherwise(F.array()).alias("verbatim"), sha))
    return written(rows, "recipes")


def exact_duplicates(docs: DataFrame, hash_of=chunk_hash) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of ``docs``.

    Of equal normalised texts the row with the smallest doc_id stays.
    """
    rows = recipes(docs, hash_of)
    groups = rows.groupBy("recipe", "verbatim").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return (rows.join(groups, ["recipe", "verbatim"])
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))


def without_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    dropped = exact_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
