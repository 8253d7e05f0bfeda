"""Operator 4: embedding near-duplicates on a robust-pruned flat graph.

Vectors are compared within a label.  Identical vectors are one node.  A label
with more than ``SHARD`` nodes is cut into clusters (k-means on a bounded sample);
every node is in its ``OVERLAP`` nearest ones, the first of which is its home, and clusters beyond ``SHARD`` are dealt into
sub-shards.  Each shard builds a robust-pruned neighbour graph of all that it has, and the
lists that a node has in several shards are united.  Then each node is
searched for in the united graph, on the nodes of every cluster that can be home to a vector in range of it
(``asked_cells``, without exception; of two shards one asks the other): greedily
with a beam of ``BEAM``, and from every hit on through all nodes in range.  A
search starts from the node itself where the shard has it, the medoid of each
group of near copies, and nodes from which all others are reached (``starts``).
Hits are verified by cosine in double precision.  ``audit`` measures recall against brute force for
the vectors whose id is divisible by 100: tasks hold chunks of nodes and read the asked ones block by block.

Vectors that are null, empty, zero, or hold null or non-finite components, and
those with a null label, link with nothing.  Vectors of different lengths don't
link.  Rows that repeat a vec_id count as vectors of their own.  An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

THRESHOLD = 0.93
#: Nodes of a shard; vectors sampled for the clusters; degree, slack and beam of the graph.
SHARD, SAMPLE, DEGREE, ALPHA, BEAM = 2048, 20_000, 24, 1.2, 32
#: Clusters that a node is built into, and nearest centres by which a cluster is ruled out.
OVERLAP, RIVALS = 2, 8
#: Nodes of a chunk and of a block that an audit compares.
CHUNK, BLOCK = 8192, 256

_KEY = ["label", "dim", "leaf", "sub"]


def _read(df: DataFrame) -> DataFrame:
    """vec_id, label, v (null unless comparable), dim."""
    v = F.col("embedding").cast("array<double>")
    fine = F.col("label").isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.when(fine, v).alias("v"))
    same = F.md5(F.array_join(F.transform("v", lambda x: x.cast("string")), ",").cast("binary"))
    return rows.withColumn("dim", F.size("v")).withColumn("same", same)


def _nodes(rows: DataFrame) -> DataFrame:
    """One node for each different vector of a label: (label, dim, same, n, lowest, v, node)."""
    each = rows.where("v is not null").groupBy("label", "dim", "same").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("lowest"), F.bool_or(F.col("vec_id") % 100 == 0).alias("asked"), F.any_value("v").alias("v"))
    return common.staged(each.withColumn("node", F.monotonically_increasing_id()), "nodes")


def _centres(nodes: DataFrame, shard: int) -> dict[tuple[str, int], np.ndarray]:
    """Cluster centres of the labels beyond one shard, from ``SAMPLE`` vectors at most (the first by hash)."""
    large = nodes.groupBy("label", "dim").count().where(F.col("count") > shard)
    sample = nodes.join(large, ["label", "dim"]).orderBy("same").limit(SAMPLE).select("label", "dim", "v", "count").collect()
    groups: dict[tuple[str, int], list] = {}
    for row in sample:
        groups.setdefault((row.label, row.dim), []).append(row)
    out = {}
    for key, rows in groups.items():
        x = np.array([r.v for r in rows])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        k = max(1, min(-(-rows[0]["count"] // shard), len(x) // 4))
        centres = x[:k].copy()
        for _ in range(8):
            home = np.argmax(x @ centres.T, axis=1)
            for c in range(k):
                if (mine := home == c).any():
                    centre = x[mine].sum(0)
                    centres[c] = centre / max(np.linalg.norm(centre), 1e-12)
        out[key] = centres
    return out


def asked_cells(x: np.ndarray, centres: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Home of each unit vector of ``x`` and, as a mask, the cells that can be home to a vector in range of it.

    The border of cells c and r is a plane through the origin.  What is nearer to r
    by more than the sine of the threshold's angle from it has nothing in range beyond.
    """
    near = x @ centres.T
    home = near.argmax(1)
    asked = np.ones(near.shape, bool)
    if threshold > 0:
        reach = np.sqrt(max(0.0, 1 - threshold * threshold))
        square = (centres * centres).sum(1)
        rivals = np.argsort(-near, axis=1, kind="stable")[:, :RIVALS]
        for rival in rivals.T:
            apart = np.sqrt(np.maximum(0, square[rival][:, None] + square - 2 * centres[rival] @ centres.T))
            asked &= near[np.arange(len(x)), rival][:, None] - near <= reach * apart + 1e-6
    asked[np.arange(len(x)), home] = True
    return home, asked


def _placed(nodes: DataFrame, centres: dict[tuple[str, int], np.ndarray], threshold: float) -> DataFrame:
    """(node, label, dim, v, leaf, built, asks): the home of a node, the clusters it is built into, and those where it is searched for."""
    schema = pa.schema([("node", pa.int64()), ("label", pa.string()), ("dim", pa.int32()), ("v", pa.list_(pa.float64())), ("leaf", pa.int32()), ("built", pa.list_(pa.int32())), ("asks", pa.list_(pa.int32()))])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                groups: dict[tuple[str, int], list] = {}
                for row in batch.to_pylist():
                    groups.setdefault((row["label"], row["dim"]), []).append(row)
                for key, members in groups.items():
                    if key not in centres:
                        yield from ((row["node"], *key, row["v"], 0, [0], [0]) for row in members)
                        continue
                    for a in range(0, len(members), 256):
                        part = members[a : a + 256]
                        x = np.array([row["v"] for row in part])
                        x /= np.linalg.norm(x, axis=1, keepdims=True)
                        home, asked = asked_cells(x, centres[key], threshold)
                        nearest = np.argsort(-(x @ centres[key].T), axis=1, kind="stable")[:, :OVERLAP]
                        for row, leaf, near, asks in zip(part, home.tolist(), nearest.tolist(), asked):
                            yield row["node"], *key, row["v"], leaf, list(dict.fromkeys([leaf, *near]))[:OVERLAP], np.flatnonzero(asks).tolist()

        yield from common.record_batches(rows(), schema, 1024)

    out = nodes.select("node", "label", "dim", "v").mapInArrow(place, "node long, label string, dim int, v array<double>, leaf int, built array<int>, asks array<int>")
    return common.staged(out, "placed")


def robust_prune(x: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA, block: int = 64) -> list[np.ndarray]:
    """Out-neighbours of each row of the unit vectors ``x``: the nearest one stays, and removes those that it is closer to by a factor of ``alpha``."""
    out = []
    pool = min(len(x) - 1, 4 * degree)
    for a in range(0, len(x), block):
        near = x[a : a + block] @ x.T
        near[np.arange(len(near)), np.arange(a, a + len(near))] = -2
        best = np.argpartition(-near, pool - 1, axis=1)[:, :pool] if pool > 0 else np.zeros((len(near), 0), int)
        value = np.take_along_axis(near, best, 1)
        order = np.argsort(-value, axis=1, kind="stable")
        best = np.take_along_axis(best, order, 1)
        away = np.maximum(0, 2 - 2 * np.take_along_axis(value, order, 1))
        each = x[best]
        between = alpha * alpha * np.maximum(0, 2 - 2 * (each @ each.transpose(0, 2, 1)))
        alive, kept = np.ones(best.shape, bool), np.zeros(best.shape, bool)
        left = np.full(len(best), degree)
        for i in range(pool):
            take = alive[:, i] & (left > 0)
            kept[:, i] = take
            left -= take
            alive &= (between[:, i] > away) | ~take[:, None]
        out += [row[mine] for row, mine in zip(best, kept)]
    return out


def _graph(key: tuple, group: pa.Table) -> pa.Table:
    node = group.column("node").to_numpy()
    order = np.argsort(node)
    node = node[order]
    x = _unit(group.column("v"))[order]
    ahead = robust_prune(x)
    back: list[list[int]] = [[] for _ in node]
    for i, js in enumerate(ahead):
        for j in js:
            if len(back[j]) < DEGREE:
                back[j].append(i)
    lists = [node[np.union1d(a, np.array(b, int)).astype(int)] for a, b in zip(ahead, back)]
    return pa.table({"node": node, "next": pa.array(lists, pa.list_(pa.int64()))})


def _unit(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def starts(x: np.ndarray, ahead: np.ndarray, threshold: float) -> np.ndarray:
    """Rows of ``x`` to search from: the medoids of all and of each group joined by links in the graph, and what those don't reach."""
    tail, column = np.nonzero(ahead >= 0)
    head = ahead[tail, column]
    link = np.einsum("ij,ij->i", x[tail], x[head]) >= threshold
    group = np.arange(len(x))
    while True:
        low = group.copy()
        np.minimum.at(low, tail[link], group[head[link]])
        np.minimum.at(low, head[link], group[tail[link]])
        low = low[low]
        if (low == group).all():
            break
        group = low
    centres = np.zeros_like(x)
    np.add.at(centres, group, x)
    order = np.lexsort((-np.einsum("ij,ij->i", x, centres[group]), group))
    first = order[np.flatnonzero(np.r_[True, np.diff(group[order]) > 0])]
    out = [int(np.argmax(x @ x.sum(0))), *first[np.bincount(group)[group[first]] > 1].tolist()]
    reached = np.zeros(len(x), bool)

    def reach(front: np.ndarray) -> None:
        reached[front] = True
        while len(front):
            to = ahead[front]
            to = np.unique(to[to >= 0])
            front = to[~reached[to]]
            reached[front] = True

    reach(np.array(out))
    while not reached.all():
        out.append(int(np.argmin(reached)))
        reach(np.array(out[-1:]))
    return np.unique(out)


def nearness(q: np.ndarray, x: np.ndarray, who: np.ndarray, to: np.ndarray, size: int = 512) -> np.ndarray:
    """Products of the rows ``who`` of ``q`` with the rows ``to`` of ``x``, a few at a time, so that they stay in the processor's cache."""
    out, left, right = np.empty(len(who)), np.empty((size, x.shape[1])), np.empty((size, x.shape[1]))
    for a in range(0, len(who), size):
        n = min(size, len(who) - a)
        q.take(who[a : a + n], 0, left[:n], "clip")
        x.take(to[a : a + n], 0, right[:n], "clip")
        np.einsum("ij,ij->i", left[:n], right[:n], out=out[a : a + n])
    return out


def search(x: np.ndarray, ahead: np.ndarray, queries: np.ndarray, threshold: float, beam: int = BEAM, block: int = 128, wide: int = 4, own: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query number, row of ``x``) of the rows in range found from the ``starts`` on.

    ``ahead``: neighbours of each row, -1 where there are fewer.  Of each query the
    best nodes seen are expanded while they are in range or among the ``beam`` best.
    A step orders those and what it newly sees, never all of ``x``.
    ``own``: the row that is the query itself, -1 where there is none.
    """
    first = starts(x, ahead, threshold)
    degree = (ahead >= 0).sum(1)
    lists, begin = ahead[ahead >= 0], np.cumsum(degree) - degree
    size = min(beam, len(x))
    for a in range(0, len(queries), block):
        q = queries[a : a + block]
        seen = np.full(len(q) * len(x), -1, np.int32)
        # The best seen of each query; in ``waits`` those that are out of range and not expanded, others as -3.  What is in range is expanded at once.
        value, waits = np.full((len(q), size), -2.0), np.full((len(q), size), -3.0)
        which = np.zeros((len(q), size), int)
        who, to = np.repeat(np.arange(len(q)), len(first)), np.tile(first, len(q))
        if own is not None:
            known = np.flatnonzero(own[a : a + block] >= 0)
            who, to = np.r_[who, known], np.r_[to, own[a : a + block][known]]
            order = np.argsort(who, kind="stable")
            who, to = who[order], to[order]
        while True:
            # ``who`` ascends; a node that several of the expanded ones name counts once.
            place = who * len(x) + to
            fresh = np.flatnonzero(seen.take(place) < 0)
            place = place.take(fresh)
            number = np.arange(len(place), dtype=np.int32)
            seen[place] = number
            fresh = fresh.take(np.flatnonzero(seen.take(place) == number))
            who, to = who.take(fresh), to.take(fresh)
            near = nearness(q, x, who, to)
            inside = np.flatnonzero(near >= threshold)
            at, hit = who.take(inside), to.take(inside)
            yield at + a, hit
            better = np.flatnonzero(near > value.min(1).take(who))
            if len(better):
                who, to, near = who.take(better), to.take(better), near.take(better)
                starts_at = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
                rows, count = who.take(starts_at), np.diff(np.r_[starts_at, len(who)])
                width = size + count.max()
                spot = np.repeat(np.arange(len(rows)) * width + size - starts_at, count) + np.arange(len(who))
                merged = []
                for held, more, none in ((value, near, -2.0), (waits, np.where(near < threshold, near, -3), -3.0), (which, to, 0)):
                    both = np.full((len(rows), width), none, held.dtype)
                    both[:, :size] = held[rows]
                    both.ravel()[spot] = more
                    merged.append(both)
                best = np.argpartition(merged[0], width - size, axis=1)[:, width - size :] + np.arange(len(rows))[:, None] * width
                value[rows], waits[rows], which[rows] = (m.ravel().take(best) for m in merged)
            live = np.flatnonzero(waits.max(1) > -3)
            w = min(wide, size)
            pick = np.argpartition(waits[live], size - w, axis=1)[:, size - w :] + live[:, None] * size
            pick = pick[waits.ravel().take(pick) > -3]
            waits.ravel()[pick] = -3
            at, hit = np.r_[at, pick // size], np.r_[hit, which.ravel().take(pick)]
            if not len(at):
                break
            order = np.argsort(at, kind="stable")
            at, hit = at.take(order), hit.take(order)
            count = degree.take(hit)
            who = np.repeat(at, count)
            to = lists.take(np.repeat(begin.take(hit) - np.cumsum(count) + count, count) + np.arange(len(who)))


def _searched(threshold: float):
    def links(key: tuple, group: pa.Table) -> pa.Table:
        graph, query = group.filter(group.column("is_graph")), group.filter(pc.invert(group.column("is_graph")))
        if not graph.num_rows or not query.num_rows:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        node = graph.column("node").to_numpy()
        at = {n: i for i, n in enumerate(node.tolist())}
        lists = [[at[n] for n in ns or () if n in at] for ns in graph.column("next").to_pylist()]
        ahead = np.full((len(lists), max(1, max(map(len, lists)))), -1)
        for row, js in zip(ahead, lists):
            row[: len(js)] = js
        asked = query.column("node").to_numpy()
        a, b = [], []
        own = np.array([at.get(n, -1) for n in asked.tolist()])
        for hit, row in search(_unit(graph.column("v")), ahead, _unit(query.column("v")), threshold, own=own):
            a.append(asked[hit])
            b.append(node[row])
        a, b = np.concatenate(a), np.concatenate(b)
        return pa.table({"a": np.minimum(a, b)[a != b], "b": np.maximum(a, b)[a != b]})

    return links


def node_links(nodes: DataFrame, threshold: float = THRESHOLD, shard: int = SHARD) -> DataFrame:
    """Links (a < b) between nodes, by the graph."""
    placed = _placed(nodes, _centres(nodes, shard), threshold)
    # Of two shards one asks the other: the lower the higher if their numbers add up to an even one, else the higher the lower.
    turn = lambda a, b: f"({a} = {b} or ({a} < {b}) = (({a} + {b}) % 2 = 0))"
    placed = placed.withColumn("asks", F.expr(f"filter(asks, c -> {turn('leaf', 'c')})"))
    asking = placed.select("label", "dim", F.explode("asks").alias("leaf"), "node", "v", F.col("leaf").alias("home"))
    built = placed.select("label", "dim", F.explode("built").alias("leaf"), "node", "v")
    sizes = built.groupBy("label", "dim", "leaf").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("subs"))
    blocks = placed.select("label", "dim", F.explode("asks").alias("leaf")).groupBy("label", "dim", "leaf").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("blocks"))
    cells = common.staged(sizes.join(blocks, ["label", "dim", "leaf"], "left").fillna(1, "blocks"), "cells")
    dealt = lambda n: F.pmod(F.xxhash64("node"), F.col(n).cast("long")).cast("int")
    members = built.join(cells, ["label", "dim", "leaf"]).withColumn("sub", dealt("subs"))
    lists = members.groupBy(*_KEY).applyInArrow(_graph, "node long, next array<long>")
    # A node's lists, one for each shard that it was built into, become one.
    lists = common.staged(lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("next"))).alias("next")), "united-lists")
    # Each sub-shard's graph meets each block of its cluster's queries.
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    graphs = members.join(lists, "node").select(*_KEY, each("blocks").alias("block"), "node", "v", "next", F.lit(True).alias("is_graph"))
    queries = asking.join(cells, ["label", "dim", "leaf"]).withColumn("own", dealt("subs")).withColumn("sub", each("subs")).where(f"home <> leaf or {turn('own', 'sub')}")
    queries = queries.select(*_KEY, dealt("blocks").alias("block"), "node", "v", F.lit(None).cast("array<long>").alias("next"), F.lit(False).alias("is_graph"))
    return graphs.unionAll(queries).groupBy(*_KEY, "block").applyInArrow(_searched(threshold), "a long, b long").distinct()


def deduplicated(df: DataFrame, threshold: float = THRESHOLD, shard: int = SHARD, audited: bool = False) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``df`` (vec_id, embedding, label); ``audited``: and the recall of this run."""
    rows = common.staged(_read(df), "vectors")
    nodes = _nodes(rows)
    links = common.staged(node_links(nodes, threshold, shard), "vector-links")
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    weight = nodes.select(F.col("node").alias("b"), "n")
    linked = both.join(weight, "b").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    roots = components(links)
    placed = nodes.select("label", "dim", "same", "node", "n", "lowest").join(linked, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = common.staged(placed, "placed-nodes")
    lowest = placed.groupBy("root").agg(F.min("lowest").alias("component_id"))
    known = placed.join(lowest, "root").select("label", "dim", "same", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    out = rows.select("vec_id", "label", "dim", "same").join(known, ["label", "dim", "same"], "left")
    measured = [F.lit(recall(nodes, links, threshold).first().recall).alias("recall")] if audited else []
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"), *measured)


def _pairs_in_range(files: list[str], threshold: float):
    """Task: (a, b) of its nodes and the asked ones of the same label in range, by brute force."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def grouped(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[tuple, np.ndarray, np.ndarray]]:
        kinds: dict[tuple, list[int]] = {}
        for i, key in enumerate(zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist())):
            kinds.setdefault(key, []).append(i)
        for key, rows in kinds.items():
            part = batch.take(pa.array(rows))
            yield key, part.column("node").to_numpy(), _unit(part.column("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                mine = {key: (node, x) for key, node, x in grouped(batch.slice(at, CHUNK))}
                for name in files:
                    fs, path = common.file_system(name)
                    with fs.open_input_file(path) as file:
                        for block in pq.ParquetFile(file).iter_batches(BLOCK):
                            for key, asked, q in grouped(block):
                                if key not in mine:
                                    continue
                                node, x = mine[key]
                                who, which = np.nonzero(q @ x.T >= threshold)
                                a, b = asked[who], node[which]
                                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[a != b]), pa.array(np.maximum(a, b)[a != b])], schema=schema)

    return run


def recall(nodes: DataFrame, links: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row: recall, the share of the true links of every vector whose id is divisible by 100 that are among ``links`` (1 without any)."""
    asked = common.staged(nodes.where("asked").select("node", "label", "dim", "v"), "asked")
    true = nodes.select("node", "label", "dim", "v").mapInArrow(_pairs_in_range(asked.inputFiles(), threshold), "a long, b long").distinct()
    both = true.join(links.select("a", "b", F.lit(1).alias("got")), ["a", "b"], "left")
    return both.agg(F.coalesce(F.try_divide(F.count("got"), F.count(F.lit(1))), F.lit(1.0)).alias("recall"))


def audit(df: DataFrame, threshold: float = THRESHOLD, shard: int = SHARD) -> float:
    """Share of the true links of every vector whose id is divisible by 100 that the graph finds (1 without any)."""
    nodes = _nodes(common.staged(_read(df), "vectors"))
    return recall(nodes, node_links(nodes, threshold, shard), threshold).first().recall
