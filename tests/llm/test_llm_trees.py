"""Merkle manifest, exact top-k and conversation trie against plain Python, and against their SQL on a small table."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from fluvia.llm import merkle, queries, topk, trie
from oracle import same

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_exact_topk", "op13_conversation_trie"])
def test_query_equals_sql(spark, name):
    same(queries.queries()[name](spark, DIR), DIR, queries.oracle_sql()[name])


# Merkle manifest


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, text):
    cell = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return _h(*[cell(v) for v in (row[0], row[3], row[2], row[4], text)])


def _tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([_h(*levels[-1][a : a + 16]) for a in range(0, len(levels[-1]), 16)])
    return levels


def _proof(levels, at):
    for level in levels[:-1]:
        first = at - at % 16
        yield level[first:at], level[at + 1 : first + 16]
        at //= 16


def manifest(rows):
    """Rows (doc_id, text, lang, source, n_chars)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append((r, _leaf(r, r[1])))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[s] = _tree([leaf for _, leaf in groups[s]])
    top = _tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for at, (r, leaf) in enumerate(groups[s]):
            steps = [*_proof(trees[s], at), *_proof(top, k)]
            bent = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            now = _leaf(r, r[1] and r[1].translate(lower)) if bent else leaf
            for left, right in steps:
                now = _h(*left, now, *right)
            out.append((r[0], leaf, trees[s][-1][0], top[-1][0], _h(*[x for step in steps for side in step for x in side]), now, now == top[-1][0]))
    return sorted(out, key=str)


def _manifest(spark, rows, extra=""):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        df = df.selectExpr("*", extra)
    out = merkle.manifest(df)
    return out, sorted([tuple(r) for r in out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()], key=str)


def test_manifest_of_deep_trees(spark):
    """A source of more than one block, sources of 1, 16 and 17 rows, one without a name, repeated ids."""
    rng = random.Random(1)
    rows = [(i, f"Text {rng.random()}", "en", "deep", i) for i in range(4500)]
    rows += [(9000 + i, "Plain Ä ß", "de", "sixteen", 3) for i in range(16)] + [(9100 + i, "no capitals", "de", "seventeen", 3) for i in range(17)]
    rows += [(9200, "Lone", None, "lone", None), (9300, None, "en", None, 0), (None, "A", "en", None, 1), (9300, "Again", "en", None, 0), (9300, "Again", "en", None, 0)]
    rows += [(9400 + i, "T", "en", f"s{i}", 1) for i in range(40)]
    rng.shuffle(rows)
    out, got = _manifest(spark, rows)
    assert got == manifest(rows)
    # A version has as many nodes as its leaf has levels above it, and they end in its root.
    changed = out.where("copied is not null and source = 'deep'").select("copied", "folded_root").collect()
    assert changed and all(len(r.copied) == 1 + 4 + 2 and r.copied[-1] == r.folded_root for r in changed)


def test_manifest_of_odd_documents(spark, odd_documents):
    rows = [tuple(r) for r in odd_documents.collect()]
    _, got = _manifest(spark, rows, extra="1 as leaf")
    assert got == manifest(rows)
    assert merkle.manifest(odd_documents.limit(0)).count() == 0
    assert _manifest(spark, rows[:1])[1] == manifest(rows[:1])


def test_versions_share_what_they_do_not_copy():
    nodes = [f"{i:02d}" for i in range(40)]
    levels = merkle.levels_of(nodes, 40)
    own = merkle.copied_path(levels, 17, "x")
    changed = merkle.levels_of([*nodes[:17], "x", *nodes[18:]], 40)
    assert own == [changed[0][17], changed[1][1], changed[2][0]]
    assert [a == b for a, b in zip(levels[1], changed[1])] == [True, False, True]
    assert levels == merkle.levels_of(nodes, 40)


# Exact top-k


def ranked(rows, k=10):
    fine = [(i, v, [math.floor(1024 * x) for x in e]) for i, (v, e) in enumerate(rows) if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, q, e in fine:
        if q is not None and q % 100 == 0:
            all_ = sorted((-min(max(sum(a * b for a, b in zip(e, f)), -(1 << 62)), 1 << 62), v is None, v or 0) for j, v, f in fine if j != i and len(f) == len(e))
            out += [(q, n + 1, None if none else v, -s) for n, (s, none, v) in enumerate(all_[:k])]
    return sorted(out, key=str)


def _nearest(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, score int") if len(rows[0]) == 4 else spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, label int, score int")
    return sorted([tuple(r) for r in topk.nearest(df, **how).collect()], key=str)


def test_topk_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(1, 1200)]
    rows += [(5000 + i, [0.5] * 8) for i in range(700)] + [(100, [0.5] * 8), (None, [0.5] * 8)]
    rows += [(2000, None), (2100, [1.0, None]), (2200, [float("nan")] * 8), (2300, []), (2301, []), (2400, [1.0, 2.0]), (2500, [1e300] * 8), (2600, [1e12] * 8), (2601, [-1e12] * 8), (2700, [0.0] * 8)]
    assert _nearest(spark, rows) == ranked(rows)
    assert _nearest(spark, rows, k=3, bins=4) == ranked(rows, 3)


def test_topk_in_small_chunks(spark, monkeypatch):
    """Chunks, blocks and passes smaller than the table; fewer candidates than k."""
    monkeypatch.setattr(topk, "CHUNK", 37)
    rng = np.random.default_rng(4)
    rows = [(100 * i if i < 30 else i, np.round(rng.normal(size=4), 1).tolist()) for i in range(500)]
    assert _nearest(spark, rows, bins=8) == ranked(rows)
    assert _nearest(spark, rows[:4]) == ranked(rows[:4])
    assert topk.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


# Conversation trie


def _key(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def forest(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, _key(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    members, texts = defaultdict(list), {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        seq = (own.get(c - c % 5, [])[:h]) + turns[h:]
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append((c, len(seq) == d))
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, who in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(who) - 1) * len(path[-1][1].encode()) if path else 0
    out = []
    for path, who in members.items():
        ends = ",".join(map(str, sorted(c for c, end in who if end)))
        low = min(c for c, _ in who)
        out.append((low, len(path), min(c for c, _ in members[path[:-1]]) if path else None, len(who), children[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def _forest(spark, rows, **how):
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int")
    return sorted([tuple(r) for r in trie.nodes(df, **how).collect()], key=str)


def _conversations(seed, n=300, kinds=4):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        if c % 11 == 0:
            continue
        for turn in range(rng.randrange(1, 9) if c % 3 else 6):
            # Few texts, so that prefixes are shared; a third of all conversations are the same one.
            text = rng.choice(["", "ä" * 3, "yes", "no", None][: kinds + 1]) if c % 3 else f"same {turn}"
            rows.append((c, turn if rng.random() > 0.05 or c % 3 == 0 else None, "user" if turn % 2 == 0 else None, text))
    return rows


@pytest.mark.parametrize("shard", [7, 60, 1 << 18])
def test_trie_in_shards(spark, shard):
    rows = _conversations(shard)
    assert _forest(spark, rows, shard=shard) == forest(rows)


def test_trie_of_odd_conversations(spark, monkeypatch):
    """Long ones, one turn, ties, repeated rows, none at all; ids below zero and without a number."""
    monkeypatch.setattr(trie, "PIECE", 3)
    long = [(50, t, "user", f"t{t % 7}") for t in range(200)]
    rows = [*long, (51, 0, "user", "x" * 100_000), (None, 1, "user", "lost"), (7, 1, None, None), (7, 1, None, None), (8, None, "a", "b"), (8, 2, "a", "c"), (8, 2, "a", "d"), (-3, 0, "a", "b"), (1 << 40, 0, "a", "b")]
    rows += [(1000 + i, 0, "user", "hello") for i in range(20)]
    assert _forest(spark, rows, shard=50) == forest(rows)
    assert _forest(spark, rows) == forest(rows)
    assert trie.nodes(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_double_array_holds_every_edge():
    rng = np.random.default_rng(5)
    for n_codes in (1, 3, 40, 400):
        parents, codes, starts = [0], [0], [0, 1]
        for _ in range(5):
            above = range(starts[-2], starts[-1])
            level = sorted({(int(p), int(c)) for p in above for c in rng.integers(0, n_codes, rng.integers(0, 6))})
            if not level:
                break
            parents += [p for p, _ in level]
            codes += [c for _, c in level]
            starts.append(len(parents))
        base, check, place = trie.pack(np.array(parents), np.array(codes), n_codes, np.array(starts))
        assert len(set(place.tolist())) == len(parents)
        for i in range(1, len(parents)):
            up = place[parents[i]]
            assert base[up] + codes[i] == place[i] and check[place[i]] == up
        # No other turn leads anywhere.
        edges = set(zip(parents[1:], codes[1:]))
        for i in range(len(parents)):
            for c in range(n_codes):
                to = base[place[i]] + c
                if (i, c) not in edges and 0 < to < len(check):
                    assert check[to] != place[i]
