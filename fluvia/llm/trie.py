"""Operator 13: the prefix trie of conversations on double arrays.

A conversation is its turns in order (null first; turns of one number by their
digests); a turn is a (role, text), null as empty.  Conversation c is rebuilt from the first h turns of
conversation c - c % 5 and its own turns after its first h.  Equal sequences are
one row with its members' number, their smallest id and the hash of their ids.

Different sequences are dealt by ranges of their order, so that a shard is a run of
neighbours: it shares with the shards beside it only nodes on its first and last
path.  A shard numbers its turns densely and packs its trie in two arrays (``pack``):
turn t leads from node s to BASE[s] + t if CHECK there is s.  Walking all its
sequences through them gives the nodes and what they count.  A node on the first or
last path (*open*) may go on in other shards: the counts of its parts are summed
over the shards, each node and each leaf counted by the first shard that holds it, which the
neighbours' last and first sequence tell.  However many conversations share a beginning,
each shard has so many turns, and shared nodes are one row for each shard.

The hash of a node's ids is of one text, so it is made in order: ids are sorted by
ranges and joined to long pieces, and one task streams a sequence's pieces.

Rows with a null conv_id belong to no conversation.  A conversation without a turn
left ends at the root.  Repeated rows are turns of their own.  An empty table gives
no rows.  A conversation's digests (24 bytes a turn) are one row.  Other columns are left aside.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .merkle import crc32_sql

SPAN, HEADS = 5, 9
#: Turns of a shard and ids of a piece of a hashed text.
SHARD, PIECE = 1 << 18, 8192

_NONE = hashlib.sha256(b"").hexdigest()


def _turns(df: DataFrame) -> DataFrame:
    """conv_id and turns: the digest (16 bytes) of each turn and the bytes of its text, in order."""
    role, text = common.text_of("role"), common.text_of("text")
    key = F.unhex(F.left(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), F.lit(32)))
    rows = df.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").cast("long").alias("turn"), key.alias("key"), F.octet_length(text).cast("long").alias("size")).alias("t"))
    ordered = F.sort_array(F.collect_list("t"))
    return rows.groupBy("conv_id").agg(ordered.alias("t")).select("conv_id", F.transform("t", lambda t: F.struct(t["key"].alias("key"), t["size"].alias("size"))).alias("turns"))


def rebuilt(df: DataFrame, span: int = SPAN, heads: int = HEADS) -> DataFrame:
    """conv_id, turns of every conversation: the beginning of the first one of its ``span``, then its own."""
    own = common.staged(_turns(df), "conversation-turns")
    first = own.where(F.col("conv_id") % span == 0).select(F.col("conv_id").alias("_of"), F.slice("turns", 1, heads).alias("_head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    both = own.withColumn("_of", F.col("conv_id") - F.col("conv_id") % span).join(first, "_of", "left").withColumn("_h", h)
    empty = F.expr("cast(array() as array<struct<key: binary, size: bigint>>)")
    head = F.coalesce(F.slice("_head", F.lit(1), F.col("_h")), empty)
    rest = F.slice("turns", F.col("_h") + 1, F.size("turns"))
    return both.select("conv_id", F.concat(head, rest).alias("turns"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (seq, conv_id) to (seq, first, n, ids): the ids of a piece joined by commas."""
    schema = pa.schema([("seq", pa.string()), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.string())])

    def rows():
        seq, held = None, []
        for batch in batches:
            for one, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and (one != seq or len(held) == PIECE):
                    yield seq, held[0], len(held), ",".join(map(str, held))
                    held = []
                seq = one
                held.append(conv)
        if held:
            yield seq, held[0], len(held), ",".join(map(str, held))

    yield from common.record_batches(rows(), schema, 256)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order of (seq, first) to (seq, n, low, ends): the hash is fed piece by piece."""
    schema = pa.schema([("seq", pa.string()), ("n", pa.int64()), ("low", pa.int64()), ("ends", pa.string())])

    def rows():
        now = None
        for batch in batches:
            for seq, first, n, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is not None and now[0] == seq:
                    now[1] += n
                    now[3].update(b"," + ids.encode())
                    continue
                if now is not None:
                    yield *now[:3], now[3].hexdigest()
                now = [seq, n, first, hashlib.sha256(ids.encode())]
        if now is not None:
            yield *now[:3], now[3].hexdigest()

    yield from common.record_batches(rows(), schema)


def sequences(conversations: DataFrame) -> DataFrame:
    """(turns, n, low, ends) of the different sequences: members, the smallest, the hash of all."""
    key = F.sha2(F.array_join(F.transform("turns", lambda t: F.hex(t["key"])), ""), 256)
    rows = common.staged(conversations.withColumn("seq", key), "rebuilt")
    pieces = rows.select("seq", "conv_id").repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id").mapInArrow(_pieces, "seq string, first long, n long, ids string")
    ends = pieces.repartition("seq").sortWithinPartitions("seq", "first").mapInArrow(_hashed, "seq string, n long, low long, ends string")
    # The smallest member brings the turns: one row for each sequence, however many share it.
    return rows.join(ends.withColumnRenamed("low", "conv_id"), ["seq", "conv_id"]).select("turns", "n", F.col("conv_id").alias("low"), "ends")


def pack(parents: np.ndarray, codes: np.ndarray, n_codes: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """BASE, CHECK and each node's place, of a trie given level by level.

    Node 0 is the root; node i hangs below ``parents``[i], by ``codes``[i] in 0..n_codes-1.
    Nodes of a level start at ``starts`` and are sorted by parent and code.  A node with
    one child takes a free place behind all codes; one with several takes the first
    base by which all fall on free places.
    """
    room = len(parents) + n_codes + 2
    base, check = np.zeros(room, np.int64), np.full(room, -1, np.int64)
    place = np.zeros(len(parents), np.int64)
    check[0] = 0
    cursor = 1  # all places before it are taken

    def grown(size: int) -> None:
        nonlocal base, check
        if size > len(check):
            more = max(size, 2 * len(check)) - len(check)
            base, check = np.append(base, np.zeros(more, np.int64)), np.append(check, np.full(more, -1, np.int64))

    end = 1  # no place from here on is taken
    for a, b in zip(starts[1:-1], starts[2:]):
        above, code = parents[a:b], codes[a:b]
        first = np.flatnonzero(np.r_[True, np.diff(above) > 0])
        count = np.diff(np.r_[first, len(above)])
        for i in first[count > 1]:
            mine = code[i : np.searchsorted(above, above[i], side="right")]
            at, step = max(cursor, int(mine[0]) + 1), 64
            while True:
                grown(at + step + n_codes + 1)
                free = at + np.flatnonzero(check[at : at + step] < 0)
                fits = (check[free[:, None] - mine[0] + mine[None, :]] < 0).all(1) if len(free) else np.zeros(0, bool)
                if fits.any():
                    shift = int(free[np.argmax(fits)]) - int(mine[0])
                    break
                # Dense beginnings are tried in growing steps, each place once.
                at, step = at + step, min(2 * step, 4096)
            to = shift + mine
            base[place[above[i]]], check[to] = shift, place[above[i]]
            place[a + i : a + i + len(mine)] = to
            end = max(end, int(to[-1]) + 1)
            while check[cursor] >= 0:
                cursor += 1
        one = first[count == 1]
        if len(one):
            at = max(cursor, n_codes + 1)
            grown(max(end, at) + len(one) + n_codes + 1)
            free = at + np.flatnonzero(check[at : max(end, at) + len(one)] < 0)[: len(one)]
            base[place[above[one]]], check[free] = free - code[one], place[above[one]]
            place[a + one] = free
            end = max(end, int(free[-1]) + 1)
    return base[:end], check[:end], place


def _common(a: list, b: list | None) -> int:
    """How many elements two sequences share from the start; -1 without a second one, which shares not even the root."""
    if b is None:
        return -1
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


_NODE = pa.schema([
    ("shard", pa.int32()), ("own", pa.string()), ("up", pa.string()), ("depth", pa.int64()), ("low", pa.int64()), ("up_low", pa.int64()), ("n", pa.int64()),
    ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string()),
])


def _shard(key: tuple, group: pa.Table) -> pa.Table:
    """The nodes of a shard.  ``own``: what tells an open node in all shards; ``up``: that of an open parent."""
    group = group.sort_by("at")
    n_seq = group.num_rows
    lists = group.column("turns").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten()
    keys = np.array(flat.field("key").to_pylist(), dtype="S16") if len(flat) else np.zeros(0, "S16")
    sizes = flat.field("size").to_numpy(zero_copy_only=False).astype(np.int64)
    # Trailing zero bytes don't count in such arrays: make the digests two numbers.
    raw = np.frombuffer(keys.tobytes(), ">u8").reshape(-1, 2) if len(keys) else np.zeros((0, 2), np.uint64)
    _, at_first, codes = np.unique(raw, axis=0, return_index=True, return_inverse=True) if len(raw) else (None, np.zeros(0, int), np.zeros(0, int))
    codes = codes.reshape(-1)
    begin = np.r_[0, np.cumsum(lengths)]
    n_codes = len(at_first)
    # Level by level: the nodes are the different (node above, turn).
    node = np.zeros(n_seq, np.int64)  # where each sequence is
    parents, turn, starts, alive = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [0, 1], np.arange(n_seq)
    depth = 0
    while len(alive := alive[lengths[alive] > depth]):
        step = node[alive] * n_codes + codes[begin[alive] + depth]
        kinds, to = np.unique(step, return_inverse=True)
        parents.append(kinds // n_codes)
        turn.append(kinds % n_codes)
        node[alive] = starts[-1] + to.reshape(-1)
        starts.append(starts[-1] + len(kinds))
        depth += 1
    parents, turn = np.concatenate(parents), np.concatenate(turn)
    base, check, place = pack(parents, turn, n_codes, np.array(starts))
    # Walk the sequences through the arrays, all of them a turn at a time.
    weight, lowest = group.column("n").to_numpy(), group.column("low").to_numpy()
    n, low = np.zeros(len(check), np.int64), np.full(len(check), np.iinfo(np.int64).max)
    size, level = np.zeros(len(check), np.int64), np.zeros(len(check), np.int64)
    state, alive, layers = np.zeros(n_seq, np.int64), np.arange(n_seq), []
    depth = 0
    while True:
        np.add.at(n, state[alive], weight[alive])
        np.minimum.at(low, state[alive], lowest[alive])
        layers.append(np.unique(state[alive]))
        level[layers[-1]] = depth
        alive = alive[lengths[alive] > depth]
        if not len(alive):
            break
        code = codes[begin[alive] + depth]
        to = base[state[alive]] + code
        if (check[to] != state[alive]).any():
            raise RuntimeError("a sequence left the trie")
        size[to] = sizes[begin[alive] + depth]
        state[alive] = to
        depth += 1
    # What this shard is the first to hold, and what the next one goes on with.
    keys_of = lambda i: [k for k in flat.field("key").slice(begin[i], lengths[i]).to_pylist()]
    first, last = keys_of(0), keys_of(n_seq - 1)
    before, after = group.column("before")[0].as_py(), group.column("after")[0].as_py()
    shared = _common(first, [t["key"] for t in before] if before is not None else None)
    goes_on = after is not None and _common(last, [t["key"] for t in after]) == len(last)
    mine = np.zeros(len(check), bool)
    mine[np.concatenate(layers)] = True
    paths = []
    for i, keys_ in ((0, first), (n_seq - 1, last)):
        s, mark, marks = 0, hashlib.sha256(), [(0, hashlib.sha256().hexdigest())]
        for code, k in zip(codes[begin[i] : begin[i + 1]], keys_):
            s = int(base[s] + code)
            mark.update(k)
            marks.append((s, mark.hexdigest()))
        paths.append(marks)
    for d, (s, _) in enumerate(paths[0]):
        if d <= shared:
            mine[s] = False
    children, leaves, saved = np.zeros(len(check), np.int64), np.zeros(len(check), np.int64), n * size
    saved[mine] -= size[mine]
    used = np.concatenate(layers)
    has_child = np.zeros(len(check), bool)
    has_child[check[np.concatenate(layers[1:])] if len(layers) > 1 else np.zeros(0, int)] = True
    leaves[used] = (~has_child[used] & mine[used]).astype(np.int64)
    if goes_on:
        leaves[paths[1][-1][0]] = 0
    for layer in reversed(layers[1:]):
        np.add.at(children, check[layer], mine[layer].astype(np.int64))
        np.add.at(leaves, check[layer], leaves[layer])
        np.add.at(saved, check[layer], saved[layer])
    own = dict(paths[0] + paths[1])
    ends = dict(zip(state.tolist(), group.column("ends").to_pylist()))
    used = used.tolist()
    up = check[used].tolist()
    low_of = low.tolist()
    return pa.table([
        pa.array([key[0].as_py()] * len(used), pa.int32()), pa.array([own.get(s) for s in used], pa.string()),
        pa.array([own.get(p) if s else None for s, p in zip(used, up)], pa.string()), pa.array(level[used]), pa.array(low[used]),
        pa.array([None if s == 0 else low_of[p] for s, p in zip(used, up)], pa.int64()), pa.array(n[used]),
        pa.array(children[used]), pa.array(leaves[used]), pa.array(saved[used]), pa.array([ends.get(s) for s in used], pa.string()),
    ], schema=_NODE)


_NODE_DDL = "shard int, own string, up string, depth long, low long, up_low long, n long, children long, leaves long, saved long, ends string"


def nodes(df: DataFrame, span: int = SPAN, heads: int = HEADS, shard: int = SHARD) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node of ``df`` (conv_id, turn, role, text)."""
    different = common.staged(sequences(rebuilt(df, span, heads)), "sequences")
    turns = different.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    # Order tells neighbours; only the digests count for it, and these tell the sizes.
    dealt = different.repartitionByRange(1 + turns // shard, "turns").sortWithinPartitions("turns").withColumn("at", F.monotonically_increasing_id())
    dealt = common.staged(dealt.withColumn("shard", F.shiftright("at", 33).cast("int")), "dealt-sequences")
    # The last sequence before a shard and the first behind it: one row for each shard.
    edges = dealt.groupBy("shard").agg(F.min_by("turns", "at").alias("first"), F.max_by("turns", "at").alias("last"))
    row = Window.orderBy("shard")
    edges = edges.select("shard", F.lag("last").over(row).alias("before"), F.lead("first").over(row).alias("after"))
    # A shard's first row brings them.
    least = dealt.groupBy("shard").agg(F.min("at").alias("at")).join(edges, "shard")
    whole = dealt.join(least, ["shard", "at"], "left")
    parts = common.staged(whole.groupBy("shard").applyInArrow(_shard, _NODE_DDL), "trie-nodes")
    open_ = parts.where("own is not null").groupBy(F.col("own").alias("mark"))
    merged = common.staged(open_.agg(F.first("depth").alias("depth"), F.first("up").alias("up"), F.min("low").alias("low"), *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")], F.max("ends").alias("ends")), "open-nodes")
    above = merged.select(F.col("mark").alias("up"), F.col("low").alias("_low"))
    # An open parent's smallest member is that of all shards; it goes to the shards by number, so that no parent is one key.
    of_shard = parts.where("own is not null").select("shard", F.col("own").alias("up")).join(above, "up")
    inner = parts.where("own is null")
    names = ["low", "depth", "up_low", "n", "children", "leaves", "saved", "ends"]
    deep = inner.where("up is null").select(*names)
    edge = inner.where("up is not null").join(of_shard, ["shard", "up"]).withColumn("up_low", F.col("_low")).select(*names)
    top = merged.join(above, "up", "left").withColumn("up_low", F.col("_low")).select(*names)
    out = deep.unionByName(edge).unionByName(top)
    return out.select(
        F.col("low").alias("conv_id"), "depth", F.col("up_low").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(_NONE)).alias("ends_sha256"),
    )


def sql() -> str:
    """The same rows by grouping all prefixes as lists, for small tables."""
    h = f"{crc32_sql('CAST(c.conv_id AS VARCHAR)')} % {HEADS}"
    return f"""
WITH own AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, role, text) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[:CAST({h} AS BIGINT)], []), c.turns[CAST({h} AS BIGINT) + 1:]) AS turns
  FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % {SPAN}),
steps AS (SELECT conv_id, turns, len(turns) AS length, unnest(range(len(turns) + 1)) AS depth FROM rebuilt),
heads AS (
  SELECT conv_id, depth, length, turns[:depth] AS path, CASE WHEN depth > 0 THEN turns[:depth - 1] END AS up,
    CASE WHEN depth > 0 THEN octet_length(encode(turns[depth].text)) ELSE 0 END AS size FROM steps),
n AS (
  SELECT depth, path, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS own_saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (length = depth), '')) AS ends_sha256
  FROM heads GROUP BY depth, path),
k AS (SELECT n.*, (SELECT count(*) FROM n c WHERE c.depth = n.depth + 1 AND c.up = n.path) AS n_children FROM n),
below AS (SELECT unnest(range(depth + 1)) AS depth, path AS whole, own_saved, n_children FROM k),
sums AS (SELECT depth, whole[:depth] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(own_saved) AS saved_tokens FROM below GROUP BY ALL)
SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, k.ends_sha256
FROM k JOIN sums ON sums.depth = k.depth AND sums.path = k.path LEFT JOIN n p ON p.depth = k.depth - 1 AND p.path = k.up
"""
