"""Benchmark decontamination against brute force: edge tables, short items, hot passages, the shuffled path."""

import hashlib
import re

import pytest

from retailmart.llm import decontamination
from retailmart.llm.decontamination import LOWER, UPPER

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SAME = "Read the following passage, then answer the question below it: "
ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Short ITEM"), (3, None), (4, "..."), (5, "one two three four five six seven eight nine ten"),
         (None, "an item that has no id but ten words of its own at least"), (6, "é ß 日本 x"), (7, SAME + "what?"), (8, SAME + "who?"), (8, "also of item eight, with other words: a b c d e f g"), (10, "ab " * 30)]
DOCS = [(1, None), (2, ""), (3, "so ONE, two three-four five six seven eight nine ten eleven!"), (4, "a short item, short  item"), (4, "one two three four five six seven eight nine ten"),
        (None, SAME + "where?"), (None, SAME + "where?"), (5, "x " * 3000 + SAME + "x " * 3000), (6, "x é ß 日本 X y"), (7, "ab " * 9), (8, "Ab " * 500), (9, "an item that has no id but ten words"),
        (11, "one two three four five six seven eight nine ten " * 2), (12, "w" * 100000), (13, "an item that has no id but ten words of its own")]


def split(text):
    return WORD.findall((text or "").translate(str.maketrans(UPPER, LOWER)))


def brute(docs, items, length=10):
    windows = {}
    for i, text in items:
        w = split(text)
        t = min(length, len(w))
        for s in range(len(w) - t + 1 if w else 0):
            windows.setdefault(tuple(w[s:s + t]), set()).update([str(i)] if i is not None else [])
    out = []
    for i, text in docs:
        w, hit, names = split(text), set(), set()
        for t in {len(x) for x in windows}:
            for s in range(len(w) - t + 1):
                if (x := tuple(w[s:s + t])) in windows:
                    hit |= set(range(s, s + t))
                    names |= windows[x]
        starts = [p for p in sorted(hit) if p - 1 not in hit]
        spans = [(p, next(q for q in range(p, len(w) + 1) if q not in hit)) for p in starts]
        out.append((i, len(w), len(hit), spans, len(names), sorted(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, [tuple(s) for s in r.spans], r.n_items, r["items"], r.items_sha256, r.contaminated) for r in df.collect()), key=repr)


def tables(spark, docs=DOCS, items=ITEMS):
    return (spark.createDataFrame([(*d, 1, "k", 7) for d in docs], "doc_id long, text string, length int, print string, wid int"),
            spark.createDataFrame([(*x, 2) for x in items], "item_id long, text string, doc_id int"))


@pytest.mark.parametrize("length", [1, 3, 10, 25])
def test_brute_force(spark, length):
    assert rows(decontamination.contamination(*tables(spark), length=length)) == brute(DOCS, ITEMS, length)


def test_shuffled_path_and_full_sieve(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(decontamination, "SIEVE", 1)
    assert rows(decontamination.contamination(*tables(spark))) == brute(DOCS, ITEMS)


def test_empty(spark):
    docs, items = tables(spark)
    assert decontamination.contamination(docs.limit(0), items).count() == 0
    got = decontamination.contamination(docs, items.limit(0))
    assert rows(got) == brute(DOCS, [])


def test_hot_passage(spark):
    docs = [(i, f"w{i} " + (SAME if i % 3 == 0 else "own words ") + f"v{i} " * 5) for i in range(600)]
    items = [(i, SAME + f"question {i}") for i in range(200)] + [(1000 + i, f"w{i} own words" + f" v{i}" * 5) for i in range(0, 600, 7)]
    assert rows(decontamination.contamination(*tables(spark, docs, items))) == brute(docs, items)


def test_every_window_has_its_fingerprint(spark):
    """Winnowed runs partition the windows: each belongs to exactly one run, whose words begin with it."""
    import numpy as np

    docs, _ = tables(spark)
    everything = np.full(64, -1)
    got = {}
    for r in decontamination.fingerprints(docs.where("doc_id IN (3, 5, 8, 11, 13)"), [10], everything).where("print IS NOT NULL").collect():
        for j in range(r.windows):
            assert got.setdefault((r.doc_id, r.first + j), r.words[j:j + 10]) == r.words[j:j + 10] and len(r.words) == r.windows + 9
    for i, text in DOCS:
        if i in (3, 5, 8, 11, 13):
            w = split(text)
            assert {s: x for (d, s), x in got.items() if d == i} == {s: w[s:s + 10] for s in range(len(w) - 9)}
