"""One registered query per operator, over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontamination, embedding_dedup, exact_dedup, minhash_dedup, mixing, periodic_runs, sentencepiece_codec, suffix_dedup, token_counts, toxicity, warc, whitening
from .common import bound


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(_table(spark, sf_dir, "pages"), warc.archive_folder(spark))
    records = warc.read_archives(manifest, payloads=False)
    return records.select(warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          warc.page_of(F.col("refers_to")).alias("refers_to"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip(_table(spark, sf_dir, "documents"))


def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(_table(spark, sf_dir, "documents"), with_kept=False).drop("kept")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"), words=3, percent=85)


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_chats(chat.canonical_turns(rows)))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = toxicity.fit(docs, labels, usable=~held_out)
    scores = toxicity.toxicity(docs, model)
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), (F.col("score") >= F.col("threshold")).alias("rejected"))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_repeats(_table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("top"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                         F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return found.selectExpr("doc_id", "n_runs", "-top.start AS start", "top.length AS length", "-top.period AS period",
                            "1000 * top.length div -top.period AS exponent_milli", "runs_sha256", "collapsed_sha256")


def with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth text, by hash of the id, ends in words repeated from a place and with a period that the hash gives."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def repeated(w):
        n = F.nullif(F.size(w), F.lit(0))
        return bound(g % n, lambda a: bound(1 + F.floor((n - a) / (3 + g % 8)), lambda p: F.array_join(
            F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + (i - a) % p).cast("int")))), " ")))

    words = F.regexp_extract_all("text", F.lit(mixing.WORD), F.lit(0))
    return docs.select("doc_id", F.when(h % 10 == 0, F.coalesce(bound(words, repeated), F.col("text"))).otherwise(F.col("text")).alias("text"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_repeated_passages": op3_repeated_passages,
    "op4_mix_sources": op4_mix_sources,
    "op5_minhash": op5_minhash,
    "op6_chat": op6_chat,
    "op7_token_counts": op7_token_counts,
    "op8_toxicity": op8_toxicity,
    "op9_embeddings": op9_embeddings,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_whitening": op11_whitening,
    "op12_decontamination": op12_decontamination,
    "op13_periodic_runs": op13_periodic_runs,
}

WARC_SQL = """
SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN strlen(body) >= 1000 AND page_id < max(page_id) OVER same THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(body) >= 1000 AND page_id < max(page_id) OVER same THEN max(page_id) OVER same END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS body FROM pages) WINDOW same AS (PARTITION BY body)
"""

# 24 characters of marks a turn; every backslash and control string inside grows by one
CHAT_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(24 + length(role) + length(text) + len(regexp_extract_all(role || chr(10) || text, '\\|<s>|</s>|\[INST\]|\[/INST\]')))::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""

MIX_SQL = r"""
WITH rows AS (
  SELECT doc_id, source, size,
         -ln((CAST('0x' || substr(md5('mix' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 1) / 4503599627370498.0::DOUBLE)
           / coalesce(1.05::DOUBLE - (length(text) - length(regexp_replace(text, '[^\p{L}\x20\x09-\x0D]+', '', 'g'))) / greatest(length(text), 1)::DOUBLE, 1.05::DOUBLE) AS key
  FROM (SELECT *, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents)),
sources AS (
  SELECT source, source_size, [5.0, 2.0, 1.0][(place - 1) % 3 + 1]::DOUBLE AS w, 3.0::DOUBLE * source_size AS cap
  FROM (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM rows GROUP BY source)),
levels AS (
  SELECT a.source, a.cap / a.w AS r,
         ((SELECT sum(source_size) FROM sources) - coalesce(sum(b.cap) FILTER (b.cap / b.w < a.cap / a.w), 0))
           / sum(b.w) FILTER (b.cap / b.w >= a.cap / a.w) AS level
  FROM sources a, sources b GROUP BY a.source, a.cap, a.w),
targets AS (
  SELECT source, source_size, least(cap, (SELECT arg_min(level, r) FROM levels WHERE level <= r) * w) AS target FROM sources),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM targets)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (epochs + CASE WHEN target > epochs * source_size
                               AND sum(size) OVER (PARTITION BY rows.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) - size / 2.0 < target - epochs * source_size
                              THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rows JOIN budgets ON rows.source IS NOT DISTINCT FROM budgets.source
"""

EXACT_SQL = r"""
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
WINDOW same AS (PARTITION BY body)
"""

CONTAMINATION_SQL = r"""
WITH items AS (
  SELECT item_id, w, least(10, len(w)) AS t
  FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark)
  WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, t, unnest(list_transform(range(1, len(w) - t + 2), lambda s: array_to_string(w[s:s + t - 1], ' '))) AS win FROM items),
docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
placed AS (
  SELECT r, t, unnest(list_transform(range(1, greatest(len(w) - t + 2, 1)), lambda s: {'s': s, 'win': array_to_string(w[s:s + t - 1], ' ')})) AS spot
  FROM docs, (SELECT DISTINCT t FROM windows)),
hits AS (SELECT r, t, s, win FROM (SELECT r, t, spot.s AS s, spot.win AS win FROM placed) SEMI JOIN windows USING (t, win)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + t)) AS p FROM hits) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits JOIN windows USING (t, win) WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

ORACLE = {"op12_decontamination": CONTAMINATION_SQL, "op1_warc": WARC_SQL, "op6_chat": CHAT_SQL, "op4_mix_sources": MIX_SQL, "op10_exact_dedup": EXACT_SQL}
