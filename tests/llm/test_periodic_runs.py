"""Periodic runs against brute force: hypothesis texts, hard strings, edge tables and the registered query."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from retailmart.llm import periodic_runs, queries


def brute(words, least=12):
    """(start, length, period) of every run, one period at a time."""
    n, found = len(words), {}
    ids = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True)[1] if n else np.zeros(0, int)
    for q in range(1, n // 2 + 1):
        same = np.r_[0, (ids[q:] == ids[:-q]).astype(int), 0]
        for a, b in zip(np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)):
            if b - a + q >= max(least, 2 * q):
                found.setdefault((a, b + q), q)  # periods come in rising order
    return sorted((int(a), int(b - a), q) for (a, b), q in found.items())


def collapsed(words, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def sequences(docs):
    """Runs and collapsed texts of lists of words, as one slice of documents."""
    texts = [" ".join(d).encode() for d in docs]
    n, doc, (start, length, period), kept = periodic_runs._chunk(np.frombuffer(b"".join(texts), np.uint8), np.r_[0, np.cumsum([len(t) for t in texts])], 12)
    runs = [sorted(zip(start[doc == i].tolist(), length[doc == i].tolist(), period[doc == i].tolist())) for i in range(len(docs))]
    return n.tolist(), runs, [k.decode() for k in kept]


def check(docs):
    n, runs, kept = sequences(docs)
    assert n == [len(d) for d in docs]
    for d, r, k in zip(docs, runs, kept):
        want = brute(d)
        assert r == want
        assert k == collapsed(d, want)


word = st.sampled_from("abc")
periodic = st.tuples(st.lists(word, min_size=1, max_size=9), st.integers(1, 40), st.integers(0, 8)).map(lambda x: (x[0] * x[1]) + x[0][:x[2]])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.one_of(periodic, st.lists(word, max_size=30)), max_size=6).map(lambda parts: [w for p in parts for w in p]), max_size=4))
def test_brute_force(docs):
    check(docs)


def test_hard_strings():
    fib, other = ["a", "b"], ["a"]
    while len(fib) < 600:
        fib, other = fib + other, fib
    thue = [str(bin(i).count("1") % 2) for i in range(512)]
    rng = np.random.default_rng(4)
    noise = [f"w{i}" for i in rng.integers(0, 9, 700)]
    mirror = ["a", "b"] * 60 + ["b", "a"] * 60
    steps = [w for i in range(1, 25) for w in ["x"] * i + ["y"]]
    long = [f"v{i}" for i in range(400)]
    check([fib, thue, noise, mirror, steps, long * 3 + long[:7], ["z"] * 700, [], ["one"], long, long, (["p"] * 13 + ["q"]) * 20])


@pytest.mark.parametrize("size", [1, 50, 1 << 20])
def test_table(spark, size, monkeypatch):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "ab " * 12), (4, "ab " * 11), (None, "a b c " * 6), (None, None), (5, "é ß 日本 " * 9 + "é"), (6, "\x0ba\x0cb\r" * 8), (7, "w" * 50000), (8, "a b " * 15),
            (9, " ".join(f"t{i % 700} " for i in range(5000)))]
    df = spark.createDataFrame([(*r, "k", 3) for r in rows], "doc_id long, text string, runs string, n_words int")
    monkeypatch.setattr(periodic_runs, "CHUNK_BYTES", size)
    got = periodic_runs.periodic_runs(df).collect()
    plain = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    want = [(i, len(w := plain(t)), r := brute(w), collapsed(w, r)) for i, t in rows]
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=repr) == sorted(want, key=repr)
    assert periodic_runs.periodic_runs(df.limit(0)).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_periodic_runs(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    repeated = 0
    for r in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            repeated += 1
        runs = brute(words)
        top = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want = (len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None, digest("".join(f"{a},{b},{q}\n" for a, b, q in runs)), digest(collapsed(words, runs)))
        assert got[r.doc_id] == want
    assert repeated > 5
