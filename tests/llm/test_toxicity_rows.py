"""Training and thresholds of the toxicity classifier count every labelled document."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from retailmart.llm import toxicity


def test_every_labelled_row_trains(spark, monkeypatch):
    n = 8000  # once 3,750 of each label at most
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.when(F.col("id") % 2 == 1, "vile words").otherwise("kind words").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    seen, improved = [], toxicity.improved
    monkeypatch.setattr(toxicity, "improved", lambda rows, *rest: seen.append(rows.count()) or improved(rows, *rest))
    model = toxicity.fit(docs, labels)
    assert seen == [n] * toxicity.ROUNDS
    scores = {r.doc_id % 2: r.score for r in toxicity.toxicity(docs.limit(2), model).collect()}
    assert scores[0] < model.thresholds["en"] <= scores[1]


def test_every_labelled_row_counts_for_the_threshold(spark):
    # 30 rows of each label: a fifth of them was too few for a threshold
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 58, "xx").alias("lang"), F.when(F.col("id") % 2 == 1, "vile words").otherwise("kind words").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    model = toxicity.fit(docs, labels)
    assert set(model.thresholds) == {"xx"}
    assert [r.doc_id for r in toxicity.without_toxic(docs, model).orderBy("doc_id").collect()] == list(range(0, 60, 2))


def test_training_reruns_agree(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.concat_ws(" ", F.lit("word"), F.col("id") % 17, F.when(F.col("id") % 3 == 0, "vile")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    a, b = (toxicity.fit(docs, labels) for _ in range(2))
    assert a.thresholds == b.thresholds and (a.embedding == b.embedding).all() and a.bias == b.bias


def test_unlabelled_texts_stay_out_of_the_join(spark):
    docs = spark.range(4000).select(F.when(F.col("id") < 3990, F.col("id") % 3900).alias("doc_id"), F.col("id").cast("string").alias("text"))
    known = spark.range(0, 3900, 13).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic"))
    got = toxicity.with_labels(docs, known)
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in docs.join(known, "doc_id").collect())
    assert "ArrowEvalPython" in got._jdf.queryExecution().executedPlan().toString()
    assert toxicity.with_labels(docs, known.where("false")).count() == 0


def hashed_batch(n: int, words: int) -> pa.RecordBatch:
    """``n`` labelled texts of ``words`` words, hashed, in one batch."""
    texts = [" ".join(f"w{(i * 7 + j) % 501}" for j in range(words)) for i in range(n)]
    batch = pa.record_batch([pa.array(range(n), pa.int64()), pa.array([i % 2 for i in range(n)], pa.int32()), pa.array(["en"] * n), pa.array(texts)], names=["doc_id", "toxic", "lang", "text"])
    return pa.Table.from_batches(toxicity.hashed([batch])).combine_chunks().to_batches()[0]


def test_thresholds_take_the_same_memory_for_large_batches(spark):
    class Rows:
        """Hands out the function that counts scores in a task."""

        sparkSession = spark

        def where(self, *_):
            return self

        def mapInArrow(self, work, schema):
            self.work = work
            return spark.createDataFrame([], schema)

    rows, model = Rows(), toxicity.start().model
    toxicity.calibrated(rows, model)
    batch, peaks = hashed_batch(1200, 500), []
    for n in (300, 1200):
        tracemalloc.start()
        bins = [b for out in rows.work(iter([batch.slice(0, n)])) for b in out.column("bin").to_pylist()]
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert len(bins) == n
    assert peaks[1] < 1.5 * peaks[0]  # the whole batch was scored at once: about 200 bytes a word


def test_word_slices_hold_every_row_once():
    batch = hashed_batch(40, 30)
    table, off = toxicity.word_tables(batch)
    for part in (batch, batch.slice(7, 20), batch.slice(0, 0)):
        found = [*toxicity.word_slices(part, most=100)]
        assert [i for rows, _, _ in found for i in rows.column("doc_id").to_pylist()] == part.column("doc_id").to_pylist()
        for rows, words, at in found:
            assert rows.num_rows == len(at) - 1 and len(words) == at[-1] and (rows.num_rows == 1 or len(words) <= 100)
            for k, i in enumerate(rows.column("doc_id").to_pylist()):
                assert np.array_equal(words[at[k]:at[k + 1]], table[off[i]:off[i + 1]])


def test_long_texts_are_trained_on_in_smaller_parts(monkeypatch):
    monkeypatch.setattr(toxicity, "WORDS_AT_ONCE", 1000)
    batch = hashed_batch(40, 98)  # 100 words each with the padding
    parts = [*toxicity.held(batch.slice(lo, 4) for lo in range(0, 40, 4))]
    assert [len(ids) for ids, _, _ in parts] == [12, 12, 12, 4]
    assert np.concatenate([ids for ids, _, _ in parts]).tolist() == list(range(40))
    assert all(len(tables) == len(ids) for ids, _, tables in parts)
