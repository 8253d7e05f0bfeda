"""Components of planted groups against brute force, with the recall of the same run."""

import numpy as np

from fluvia.llm import vectors


def _brute(rows, threshold=vectors.THRESHOLD):
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    x = np.array([v for _, v, _ in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    link = (x @ x.T >= threshold) & (label[:, None] == label)
    np.fill_diagonal(link, False)
    for i, j in zip(*np.nonzero(np.triu(link))):
        a, b = sorted((find(i), find(j)))
        root[b] = a
    lowest = {}
    for i, (vec, _, _) in enumerate(rows):
        lowest[find(i)] = min(vec, lowest.get(find(i), vec))
    return {vec: (int(link[i].sum()), lowest[find(i)], vec == lowest[find(i)]) for i, (vec, _, _) in enumerate(rows)}


def test_components_of_planted_groups(spark):
    """Groups beyond a shard, chains of near copies, exact copies and loners, in labels of several shards."""
    rng = np.random.default_rng(11)
    rows, n = [], 0

    def add(vectors_, label):
        nonlocal n
        for v in vectors_:
            rows.append((n, [float(c) for c in v], label))
            n += 1

    for label in (1, 2):
        for _ in range(4):
            centre = rng.normal(size=12)
            add(centre + rng.normal(size=(90, 12)) * 0.12, label)
        add(rng.normal(size=(200, 12)), label)
        step = rng.normal(size=12)
        for _ in range(40):
            step = step + rng.normal(size=12) * 0.2
            add([step], label)
        add([rng.normal(size=12)] * 7, label)
    order = rng.permutation(len(rows))
    rows = [rows[i] for i in order]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = vectors.deduplicated(df, shard=64, audited=True).collect()
    want = _brute(rows)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == want
    assert {r.recall for r in got} == {1.0} and sum(n for n, _, _ in want.values()) > 10_000


def test_recall_counts_what_is_missing(spark):
    rng = np.random.default_rng(12)
    centre = rng.normal(size=8)
    rows = [(k, [float(c) for c in centre + rng.normal(size=8) * 0.05], 1) for k in range(250)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    nodes = vectors._nodes(vectors._read(df))
    links = vectors.node_links(nodes, shard=64)
    assert vectors.recall(nodes, links).first().recall == 1.0
    asked = {r.node for r in nodes.where("asked").collect()}
    assert len(asked) == 3
    some = links.where(~links.a.isin(*asked) & ~links.b.isin(*asked))
    assert vectors.recall(nodes, some).first().recall == 0.0
    assert vectors.recall(nodes.limit(0), links).first().recall == 1.0


def _shard(n, rng):
    """Scattered unit vectors, every tenth with a near copy, and their graph as rows of -1 filled lists."""
    x = rng.normal(size=(n, 32))
    x[: n // 10] = x[n // 10 : 2 * (n // 10)] + rng.normal(size=(n // 10, 32)) * 0.05
    x = x[rng.permutation(n)]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lists = vectors.robust_prune(x)
    ahead = np.full((n, max(map(len, lists))), -1)
    for row, js in zip(ahead, lists):
        row[: len(js)] = js
    return x, ahead


def test_a_step_of_a_search_orders_no_whole_shard(monkeypatch):
    """What a search orders at a step follows the beam and the lists, whatever the shard holds; the links are those of brute force."""
    rng = np.random.default_rng(13)
    x, ahead = _shard(3000, rng)
    ordered = []
    for name in ("partition", "argpartition"):
        monkeypatch.setattr(vectors.np, name, lambda m, *a, _f=getattr(np, name), **b: (ordered.append(m.shape[-1]), _f(m, *a, **b))[1])
    found = [(q, r) for q, r in vectors.search(x, ahead, x[:500], vectors.THRESHOLD, own=np.arange(500))]
    monkeypatch.undo()
    pairs = [p for q, r in found for p in zip(q.tolist(), r.tolist())]
    want = set(zip(*(v.tolist() for v in np.nonzero(x[:500] @ x.T >= vectors.THRESHOLD))))
    assert len(pairs) == len(set(pairs)) and set(pairs) == want and len(want) > 550
    assert ordered and max(ordered) < 1000


def test_lists_are_pruned_as_one_by_one():
    rng = np.random.default_rng(14)
    x = rng.normal(size=(150, 6))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for n, degree in ((150, 5), (70, 24), (3, 24), (1, 24)):
        part = x[:n]
        for i, got in enumerate(vectors.robust_prune(part, degree)):
            others = sorted((j for j in range(n) if j != i), key=lambda j: -float(part[i] @ part[j]))[: 4 * degree]
            want = []
            for j in others:
                if len(want) < degree and all(vectors.ALPHA * np.linalg.norm(part[j] - part[k]) > np.linalg.norm(part[i] - part[j]) for k in want):
                    want.append(j)
            assert got.tolist() == want
