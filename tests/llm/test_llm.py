"""Every operator against SQL, a brute-force version, a round trip or held-out accuracy."""

import collections
import hashlib
import json

import duckdb
import numpy as np
import pytest
from conftest import SF_SMALL
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from retailmart.llm import chat, embedding_dedup, exact_dedup, minhash_dedup, mixing, queries, sentencepiece_codec, suffix_dedup, token_counts, toxicity, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id long, kept boolean, h string, copies int"
BASE = " ".join(f"word{i} thing{i % 7}" for i in range(60))
ROWS = [(1, None), (2, ""), (3, "a b"), (4, "A \t b"), (5, "A b"), (6, "one"), (7, BASE), (8, BASE + " end"), (9, BASE.replace("word30", "other")),
        (10, "x" * 5000), (11, " " * 300), (11, " " * 300), (12, "aß日本 " * 700), (13, "new " + BASE[100:400]), (None, BASE), (14, "\n\n" + BASE + "\n")]


def edge_docs(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, None if i == 3 else "en", None if i == 4 else f"s{(i or 0) % 2}", None, 1, None, "x", 5) for i, t in rows], SCHEMA)


def small(spark, name="documents"):
    return spark.read.parquet(f"{SF_SMALL}/{name}.parquet")


def texts(df):
    return [(r.doc_id, (r.text or "").encode()) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF_SMALL)
    rel = duck.execute(queries.ORACLE[name])
    cols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(df.columns)
    key = lambda r: tuple(repr(x) for x in r)
    assert sorted(map(key, df.select(*cols).collect())) == sorted(map(key, rel.fetchall()))


def collapse(t):
    return b" ".join(x for x in __import__("re").split(rb"[\x20\x09-\x0D]+", t))


@pytest.mark.parametrize("weak", [False, True])
def test_exact(spark, weak):
    docs = edge_docs(spark)
    hash_of = (lambda c: F.pmod(F.xxhash64(c), F.lit(2).cast("long"))) if weak else exact_dedup.chunk_hash
    got = exact_dedup.exact_duplicates(docs, hash_of).collect()
    groups = collections.defaultdict(list)
    for i, t in texts(docs):
        groups[collapse(t)].append(i)
    want = []
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep, hashlib.sha256(t).hexdigest()) for i in ids]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def repeats(rows, length=50):
    seen, out = set(), {}
    for i, t in sorted(x for x in rows if x[0] is not None):
        hit = [j for j in range(len(t) - length + 1) if t[j:j + length] in seen]
        cover = {q for j in hit for q in range(j, j + length)}
        kept = bytes(x for q, x in enumerate(t) if q not in cover)
        out[i] = (len(t), len(cover), sum(q - 1 not in cover for q in cover), hashlib.sha256(kept).hexdigest())
        seen.update(t[j:j + length] for j in range(len(t) - length + 1))
    return out


@pytest.mark.parametrize("which", ["edge", "small"])
def test_repeated_passages(spark, which):
    docs = edge_docs(spark) if which == "edge" else small(spark)
    got = suffix_dedup.repeated_passages(docs).collect()
    want = repeats(dict((i, t) for i, t in texts(docs)).items())
    assert len(got) == docs.count()
    for r in got:
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
        if r.doc_id is not None:
            assert tuple(r)[1:5] == want[r.doc_id]
        else:
            assert r.n_removed == 0


HOT_PHRASE = "a stock phrase of 24 byte"


def hot_docs(spark):
    rng = np.random.default_rng(5)
    own = ["".join(chr(97 + c) for c in rng.integers(0, 26, 120)) for _ in range(600)]
    rows = [(i, t[:60] + HOT_PHRASE + t[60:]) for i, t in enumerate(own)]
    rows += [(1000 + i, "new " + own[i][40:60] + HOT_PHRASE + own[i][60:80 - i % 3]) for i in range(0, 600, 20)]
    rows += [(2000 + i, own[i][:30] + "x" * (80 + i) + "the same passage of many documents, longer than a window is" + own[i][30:50]) for i in range(100)]
    return edge_docs(spark, rows + [(2000, "y" * 200), (None, rows[0][1])])


@pytest.mark.parametrize("hot_bytes", [1, 2000, 1 << 22])
def test_repeated_passages_hot_phrase(spark, hot_bytes):
    docs = hot_docs(spark)
    got = suffix_dedup.repeated_passages(docs.where("doc_id <> 2000"), hot_bytes=hot_bytes).collect()
    want = repeats([x for x in texts(docs) if x[0] not in (None, 2000)])
    assert {r.doc_id: tuple(r)[1:5] for r in got} == want
    got = suffix_dedup.repeated_passages(docs, hot_bytes=hot_bytes).collect()  # a document with two texts
    assert len(got) == docs.count() and all(r.n_removed == 0 for r in got if r.doc_id is None)


def test_hot_phrase_is_split(spark):
    docs, most = hot_docs(spark).where("doc_id < 1000 OR doc_id >= 1000 AND doc_id < 2000"), {}
    for hot_bytes in (2000, 1 << 22):
        _, cut = suffix_dedup.dealt_segments(docs, suffix_dedup.LENGTH, suffix_dedup.GRAM, hot_bytes)
        size = collections.Counter()
        for r in cut.where("kind = 0").collect():
            size[r.bucket] += len(suffix_dedup._unpack(bytes(r.data))[1])
        most[hot_bytes] = max(size.values())
    assert most[1 << 22] > 10000  # the segments of a phrase in one bucket
    assert most[2000] < most[1 << 22] / 2


def near(rows, words, percent):
    sets, up = {}, {}
    for i, t in rows:
        w = t.lower().split()
        sets[i] = {tuple(w[j:j + words]) for j in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()
        up[i] = i

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("which", ["edge", "small"])
def test_near_duplicates(spark, which):
    docs = edge_docs(spark) if which == "edge" else small(spark)
    got = minhash_dedup.near_duplicates(docs, 3, 85).collect()
    want = near([x for x in texts(docs) if x[0] is not None], 3, 85)
    assert len(got) == docs.count()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)


def test_embeddings(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((3, 8))
    vectors = [(b + rng.standard_normal(8) * 0.04).astype("f4").tolist() for b in base for _ in range(90)]
    rows = [(i, v, i % 2) for i, v in enumerate(vectors)]
    rows += [(900, vectors[0], 0), (901, vectors[0], 0), (902, vectors[0], None), (903, None, 0), (904, [0.0] * 8, 0), (905, [None] * 8, 0), (906, [float("nan")] * 8, 0), (907, [], 0), (908, vectors[0][:4], 0), (None, vectors[0], 0)]
    df = spark.createDataFrame([(*r, 7) for r in rows], "vec_id long, embedding array<float>, label int, links int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicate_vectors(df, window=16).collect()}
    good = [r for r in rows if r[0] is not None and r[2] is not None and r[1] and len(r[1]) == 8 and all(x is not None and x == x for x in r[1]) and any(r[1])]
    x = np.array([r[1] for r in good], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = (x @ x.T >= 0.98) & (np.array([r[2] for r in good])[:, None] == np.array([r[2] for r in good])) & ~np.eye(len(x), dtype=bool)
    ids = np.array([r[0] for r in good])
    found = sum(got[i][0] for i in ids)
    assert link.sum() * 0.99 <= found <= link.sum()
    assert all(got[i][0] <= n for i, n in zip(ids, link.sum(1)))
    assert all(got[i] == (0, i, True) for i in (902, 903, 904, 905, 906, 907, 908, None))


def test_embeddings_dense(spark):
    rng = np.random.default_rng(2)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    apart = lambda x, angle: np.cos(angle) * x + np.sin(angle) * unit((w := rng.standard_normal(x.shape)) - (w * x).sum(-1, keepdims=True) * x)
    middle, hub = unit(rng.standard_normal((2, 64)))
    dense = unit(middle + rng.standard_normal((3000, 64)) * 0.04)  # cosines near 0.9 within the label
    pairs = apart(dense[:500], 0.19)
    around = apart(np.tile(hub, (300, 1)), np.linspace(0.05, 0.19, 300)[:, None])
    x = np.concatenate([dense, pairs, hub[None], around]).astype("f4")
    label = np.r_[np.zeros(3500, int), np.ones(301, int)]
    df = spark.createDataFrame([(i, v.tolist(), int(y)) for i, (v, y) in enumerate(zip(x, label))], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicate_vectors(df).collect()}
    x = unit(x.astype(float))
    link = (x @ x.T >= 0.98) & (label[:, None] == label) & ~np.eye(len(x), dtype=bool)
    root = np.arange(len(x))
    while not np.array_equal(new := np.where(link, root, len(x)).min(1, initial=len(x)).clip(max=root), root):
        root = new
    assert link.sum() > 1500
    assert got == {i: (int(n), int(r), bool(r == i)) for i, (n, r) in enumerate(zip(link.sum(1), root))}


def test_embeddings_spread(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((4000, 32))
    x = np.concatenate([base, base[:1000] + rng.standard_normal((1000, 32)) * 0.19])
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x.astype("f4"))], "vec_id long, embedding array<float>, label int")
    plan = embedding_dedup.depths(df.selectExpr("label", "32 AS dim", "embedding AS vector", "vec_id AS rep"), "turn int, dim int, label int, key long, rep long", 0.98, 64).first()
    assert plan.depth > 0 and plan.passes == embedding_dedup.passes_for(plan.depth, 0.98) > 1
    got = sum(r.n_links for r in embedding_dedup.near_duplicate_vectors(df).collect())
    x = x.astype("f4").astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = int((x @ x.T >= 0.98).sum()) - len(x)
    assert want > 500 and want * 0.998 <= got <= want


def test_sentencepiece(spark):
    import sentencepiece

    own = [t for _, t in ROWS] + ["\x00a▁", "  two  spaces\n", "😀 ﬁ ①", " " * 700 + "ab" * 3000]
    lib = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    docs = edge_docs(spark, list(enumerate(own)))
    coded = sentencepiece_codec.encode(docs)
    got = {r.doc_id: r.tokens for r in coded.collect()}
    assert got == {i: lib.encode(t or "") for i, t in enumerate(own)}
    back = {r.doc_id: r.text for r in sentencepiece_codec.decode(coded).collect()}
    assert back == {i: (t or "").replace("▁", " ") for i, t in enumerate(own)}
    assert all(r.same for r in sentencepiece_codec.round_trip(docs.where("doc_id <> 16")).collect())


@pytest.mark.parametrize("rule", ["start", "end"])
def test_token_counts(spark, rule):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    lib.encode_special_tokens = True
    docs = edge_docs(spark, [x for x in ROWS if x[0] is not None])
    got = {r.doc_id: r for r in token_counts.token_counts(docs, rule=rule).collect()}
    for r in docs.collect():
        whole = "\n".join([r.source or "", r.lang or "", r.text or ""])
        ends = [len(r.source or "") + 1, len(r.source or "") + len(r.lang or "") + 2]
        starts = [0, *ends] + [i + 1 for i, c in enumerate(whole) if c == "\n" and ends[1] < i + 1 < len(whole)]
        spans = lib.encode(whole, add_special_tokens=False).offsets
        place = lambda c: sum(s <= c for s in starts) - 1
        where = [place(a if rule == "start" else max(a, b - 1)) for a, b in spans]
        assert got[r.doc_id].section_tokens == [where.count(i) for i in range(len(starts))]
        assert got[r.doc_id].n_tokens == len(spans)


def test_toxicity(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = toxicity.fit(docs, labels, ~held)
    rows = toxicity.toxicity(docs, model).join(labels.where(held), "doc_id").collect()
    s, y = np.array([r.score for r in rows]), np.array([r.toxic for r in rows])
    assert (s[y == 1][:, None] > s[y == 0]).mean() > 0.9
    assert all(0 <= r.score <= 1 for r in toxicity.toxicity(edge_docs(spark), model).collect())
    with pytest.raises(ValueError):
        toxicity.fit(docs, labels.where("toxic = 0"))


@pytest.mark.parametrize("split", [64, 1000, 1 << 20])
def test_warc(spark, tmp_path, split):
    rows = [(1, "http://a/ä\r\nX: y", None), (2, None, ""), (3, "u", "é" * 999), (4, "u", "é" * 999), (None, "u", "é" * 999), (5, "u", "WARC/1.1\r\n\r\n" * 300), (6, "u", "ab" * 20), (7, "u", "ab" * 20)]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, sha string")
    manifest = warc.write_archives(pages, str(tmp_path / "w"))
    got = {r.record_id: r for r in warc.read_archives(manifest, split).collect()}
    assert len(got) == len(rows)
    for i, _, html in rows:
        r, payload = got[warc.page_urn(i)], (html or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha1(payload).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", warc.page_urn(4)) if i == 3 else ("response", None))
        assert r.payload == (None if i == 3 else payload)
    assert warc.read_archives(warc.write_archives(pages.limit(0), str(tmp_path / "e"))).count() == 0


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "</s>", ""]), st.text(alphabet="ab\\<>/s[]INST \n", max_size=40))))
def test_chat_escapes(turns):
    formatted, loss = chat.render([{"role": r, "text": t} for r, t in turns])
    assert chat.parse(formatted) == turns
    assert "".join(chat.unescape(formatted[x["start"]:x["end"]]) for x in loss) == "".join(t for r, t in turns if r == "assistant")


def test_chat_layouts(spark):
    records = [{"prompt": "p", "response": "r"}, {"instruction": "i", "input": "x", "output": "o", "conv_id": 3}, {"messages": [{"role": "user", "content": None}]},
               {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, {"data": {"question": "q", "answer": "a"}}, {"other": 1}, None, "broken"]
    df = spark.createDataFrame([(i, json.dumps(r) if r != "broken" else "{") for i, r in enumerate(records)], "conv_id long, raw string")
    got = {r.conv_id: r.turns and [tuple(t) for t in r.turns] for r in chat.canonical_turns_json(df, "raw").collect()}
    assert got == {0: [("user", "p"), ("assistant", "r")], 1: [("user", "i\n\nx"), ("assistant", "o")], 2: [("user", "")], 3: [("user", "q"), ("assistant", "a")], 4: [("user", "q"), ("assistant", "a")], 5: None, 6: None, 7: None}
    table = spark.createDataFrame([(1, "p", None, 5)], "conv_id long, prompt string, response string, n int")
    assert [tuple(t) for t in chat.canonical_turns(table).first().turns] == [("user", "p")]
    with pytest.raises(ValueError):
        chat.canonical_turns(spark.createDataFrame([(1,)], "conv_id long"))


def test_mix(spark):
    rows = mixing.mix_sources(edge_docs(spark), edge_rows=0).collect()
    assert len(rows) == len(ROWS)
    taken = collections.Counter()
    for r in rows:
        taken[r.source] += r.taken
        assert r.taken == r.size * r.copies <= 3 * r.size
    for r in rows:
        assert abs(taken[r.source] - r.target) <= max(x.size for x in rows)
    docs = edge_docs(spark).where("doc_id IS NOT NULL AND doc_id <> 11")
    assert mixing.mixed(docs).count() == mixing.mix_sources(docs).agg(F.sum("copies")).first()[0]


def test_empty_tables(spark):
    docs = edge_docs(spark, []) if False else edge_docs(spark).limit(0)
    assert exact_dedup.exact_duplicates(docs).count() == 0
    assert mixing.mix_sources(docs).count() == 0
    assert minhash_dedup.near_duplicates(docs).count() == 0
    assert suffix_dedup.repeated_passages(docs).count() == 0
    assert sentencepiece_codec.encode(docs).count() == 0
    assert embedding_dedup.near_duplicate_vectors(small(spark, "embeddings").limit(0)).count() == 0


def test_pipeline_stages(spark):
    docs = small(spark)
    names = dict(corpus_pipeline.STAGES)
    one = corpus_pipeline.written(names["exact dedup"](spark, docs, SF_SMALL), "t")
    firsts = {}
    for i, t in sorted(texts(docs)):
        firsts.setdefault(collapse(t), i)
    assert sorted(i for i, _ in texts(one)) == sorted(firsts.values())
    two = corpus_pipeline.written(names["near dedup"](spark, one, SF_SMALL), "t")
    want = near(texts(one), 5, 80)
    assert sorted(i for i, _ in texts(two)) == sorted(i for i, (_, c) in want.items() if i == c)
    assert one.columns == two.columns == docs.columns
    last = corpus_pipeline.run(spark, SF_SMALL)
    assert last.count() > 0 and "tokens" in last.columns


def test_pipeline_run(spark):
    import sentencepiece

    docs = small(spark)
    stages, names = [docs], [n for n, _ in corpus_pipeline.STAGES]
    for _, stage in corpus_pipeline.STAGES:
        stages.append(corpus_pipeline.written(stage(spark, stages[-1], SF_SMALL), "t"))
    assert names == ["toxicity", "exact dedup", "near dedup", "mixing", "sentencepiece"]
    rows = [x.collect() for x in stages]
    plain = lambda found: sorted(repr(tuple(r)) for r in found)
    # scored and thresholded one document at a time
    model = toxicity.fit(docs, small(spark, "labels"))
    score = lambda t: model.scores(*toxicity.features(np.frombuffer(t, np.uint8), np.array([0, len(t)])))[0]
    clean = [r for r in rows[0] if score((r.text or "").encode()) < model.thresholds.get(r.lang, toxicity.THRESHOLD)]
    assert 0 < len(clean) <= len(rows[0]) and plain(rows[1]) == plain(clean)
    firsts = {}
    for r in sorted(clean, key=lambda r: r.doc_id):
        firsts.setdefault(collapse((r.text or "").encode()), r)
    assert plain(rows[2]) == plain(firsts.values())
    group = near([(r.doc_id, (r.text or "").encode()) for r in firsts.values()], 5, 80)
    left = [r for r in firsts.values() if group[r.doc_id][1] == r.doc_id]
    assert plain(rows[3]) == plain(left)
    copies = plain_mix(left)
    assert plain(rows[4]) == plain(r for r in left for _ in range(copies[r.doc_id]))
    lib = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    want = sorted((r.doc_id, r.lang, r.source, lib.encode(r.text or "")) for r in left for _ in range(copies[r.doc_id]))
    for got in (rows[5], corpus_pipeline.run(spark, SF_SMALL).collect()):
        assert sorted((r.doc_id, r.lang, r.source, list(r.tokens)) for r in got) == want


def plain_mix(rows, weights=(5, 2, 1), most=3.0):
    """Copies by doc_id: sources share all words by weight, at most ``most`` times their own; whole epochs, then by key."""
    import math
    import re

    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows}
    sources = sorted({r.source for r in rows})
    words = {s: sum(size[r.doc_id] for r in rows if r.source == s) for s in sources}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    target, free, budget = {}, set(sources), float(sum(words.values()))
    while free:
        level = budget / sum(weight[s] for s in free)
        full = {s for s in free if most * words[s] < level * weight[s]}
        target |= {s: most * words[s] for s in full} if full else {s: level * weight[s] for s in free}
        budget -= sum(target[s] for s in full)
        free = free - full if full else set()

    def key(r):
        u = (int(hashlib.md5(f"mix{r.doc_id}".encode()).hexdigest()[:13], 16) + 1) / float(2**52 + 2)
        text = r.text or ""
        other = sum(not (c.isalpha() or c in " \t\n\v\f\r") for c in text)
        return -math.log(u) / (1.05 - other / max(len(text), 1))

    copies = {}
    for s in sources:
        epochs = math.floor(target[s] / words[s]) if words[s] else 0
        need, total = target[s] - epochs * words[s], 0
        for r in sorted((r for r in rows if r.source == s), key=lambda r: (key(r), r.doc_id)):
            total += size[r.doc_id]
            copies[r.doc_id] = epochs + (need > 0 and total - size[r.doc_id] / 2 < need)
    return copies
