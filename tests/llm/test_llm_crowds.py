"""Sets that share a passage with very many others: they meet by their rarest shingles, and lose no link."""

import random

import numpy as np
from pyspark.sql import functions as F

from fluvia.llm import common, jaccard


def test_similar_sets_show_each_other_a_rare_shingle():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 9, 1 << jaccard.SLOTS).astype(np.uint32)
    met = 0
    for _ in range(4000):
        n = int(rng.integers(1, 80))
        x = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        keep = x[rng.random(len(x)) > rng.random() * 0.35]
        y = np.unique(np.concatenate([keep, rng.integers(0, 1 << 62, int(rng.integers(0, max(1, n // 4) + 1))).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        if not len(y) or 4 * both < 3 * (len(x) + len(y) - both):
            continue
        met += 1
        small, large = (x, y) if len(x) <= len(y) else (y, x)
        few, shown = jaccard.rarest(small, counts)
        assert np.isin(few[:shown], jaccard.rarest(large, counts)[0]).any()
    assert met > 500


def _crowd(n, seed=3):
    """Documents of 64 common words and 16 of their own; every tenth has a copy that differs in one word, and chains of small steps run between some."""
    rng = random.Random(seed)
    passage = [f"s{i}" for i in range(64)]
    rows = []
    for i in range(n):
        own = [f"u{i}x{k}" for k in range(16)]
        rows.append((i, " ".join(passage + own)))
        if i % 10 == 0:
            own[rng.randrange(16)] = "changed"
            rows.append((100_000 + i, " ".join(passage + own)))
    chain = [f"c{k}" for k in range(80)]
    for step in range(12):
        rows.append((200_000 + step, " ".join(passage[:20] + chain)))
        chain[(step * 7) % 80] = f"step{step}"
    return rows


def _sets(rows):
    out = {}
    for i, text in rows:
        words = text.split()
        out[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
    return out


def test_a_common_passage_makes_no_pairs_and_loses_none(spark, monkeypatch):
    rows = _crowd(200)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = _sets(rows)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = {r.doc_id: r.component_id for r in jaccard.joined(df).collect()}
    want = {i: find(i) for i in ids}
    assert got == want
    # With every part a crowd, and with none.
    for few in (0, 10**9):
        monkeypatch.setattr(jaccard, "FEW", few)
        assert {r.doc_id: r.component_id for r in jaccard.joined(df).collect()} == want


def test_pairs_grow_with_the_documents(spark):
    """Twice the documents with one passage make about twice the pairs, not four times."""
    made = []
    for n in (200, 400):
        sets = [(i, np.sort(np.array([hash(s) & (2**63 - 1) for s in shingles], np.uint64))) for i, shingles in _sets(_crowd(n)).items()]
        held = common.staged(spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in sets], "node long, shingles binary"), "held")
        short = common.staged(spark.createDataFrame([(i, len(s), *jaccard.short_sketch(s)) for i, s in sets], "node long, n int, " + ", ".join(f"w{k} long" for k in range(jaccard.SKETCH_WORDS))), "short")
        crowd = held.select("node", F.col("node").alias("root"))
        made.append(jaccard._between_many(held, crowd, short).count())
    assert 20 <= made[0] <= 200 and made[1] <= 3 * made[0]
