"""Near-duplicate groups larger than a block lose no link, and connected components against union-find."""

import numpy as np
import pytest
from test_llm import edge_docs, near, small, texts

from retailmart.llm import minhash_dedup
from retailmart.llm.common import beside_hub, joined
from retailmart.llm.components import connected_components


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BUCKET_BLOCK", 8)
    monkeypatch.setattr(minhash_dedup, "SET_BLOCK", 6)
    monkeypatch.setattr(minhash_dedup, "SET_BLOCK_SHINGLES", 1500)


def copies(n, seed, words=120):
    """Texts near one another, a chain that drifts, and a second group that agrees with the first in part."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for i in range(n):
        own = list(base)
        for j in rng.integers(0, words, 2):
            own[j] = f"x{i}-{j}"
        out.append(" ".join(own))
    drift = list(base)
    for i in range(n // 2):
        drift[(7 * i) % words] = f"d{i}"
        out.append(" ".join(drift))
    other = [f"v{i}" if i % 9 == 0 else w for i, w in enumerate(base)]
    for i in range(n // 3):
        own = list(other)
        own[int(rng.integers(0, words))] = f"y{i}"
        out.append(" ".join(own))
    out.append(" ".join(base * 40))
    return list(enumerate(out))


@pytest.mark.parametrize("which", ["edge", "small", "copies"])
def test_small_blocks(spark, small_blocks, which):
    docs = {"edge": lambda: edge_docs(spark), "small": lambda: small(spark), "copies": lambda: edge_docs(spark, copies(90, 3))}[which]()
    got = minhash_dedup.near_duplicates(docs, 3, 85).collect()
    want = near([x for x in texts(docs) if x[0] is not None], 3, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert len(got) == docs.count()


def test_loose_members_meet_all(spark, small_blocks, monkeypatch):
    """The copies of the second group reach the first only through the pieces of loose members."""
    dealt, plain = [], minhash_dedup.loose_to_all
    monkeypatch.setattr(minhash_dedup, "loose_to_all", lambda rows, *a: dealt.append(rows.columns[0]) or plain(rows, *a))
    docs = edge_docs(spark, copies(60, 9))
    got = minhash_dedup.near_duplicates(docs, 3, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == near([x for x in texts(docs) if x[0] is not None], 3, 85)
    assert "component" in dealt


@pytest.mark.parametrize("links", [0, 30, 60, 120, 400])
def test_hub_and_loose(links):
    """Links kept of the pieces and of loose members against all connect what the links connect."""
    rng = np.random.default_rng(links)
    for _ in range(20):
        n = 80
        block = rng.integers(0, 6, n)
        a, b = np.sort(rng.integers(0, n, (2, links)), axis=0)
        a, b = a[a != b], b[a != b]
        kept, loose = [], np.zeros(n, bool)
        for i in range(6):
            at = np.flatnonzero((block == 0) | (block == i))
            inside = np.isin(a, at) & np.isin(b, at)
            x, y, apart = beside_hub(block[at] == 0, np.searchsorted(at, a[inside]), np.searchsorted(at, b[inside]))
            kept.append((at[x], at[y]))
            loose[at] |= apart
        more = loose[a] | loose[b]
        x, y = (np.concatenate(z) for z in zip(*kept, (a[more], b[more])))
        assert np.array_equal(joined(n, x, y)[2], joined(n, a, b)[2])


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(2, 1), (3, 2), (4, 3), (9, 8), (8, 9), (20, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)] + [(70, i) for i in range(40, 60)],
                                   [(int(a), int(b)) for a, b in np.random.default_rng(6).integers(0, 300, (200, 2))]])
def test_components(spark, edges):
    up = {x: x for e in edges if e[0] != e[1] for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            up[y] = x
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted((r.id, r.component) for r in got) == sorted((x, root(x)) for x in up)
