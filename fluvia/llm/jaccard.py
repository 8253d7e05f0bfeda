"""Operator 8: n-gram Jaccard join by parity sketches.

A document's set is that of its distinct 5-word shingles, hashed to 64 bits.
Sets of n and m elements with a similarity of 3/4 or more differ in at most
(n + m) / 7 elements.  Sets are put in bands of size (powers of four; one within
a third of the next band is a guest there as well).  In a band the hash space is
cut into parts; XOR-ing the elements of each part gives a parity sketch, and each
differing element changes one part at most, so the number of parts that differ
bounds the symmetric difference from below.  By the pigeonhole principle two
similar sets share one of the first d + 1 parts that are not empty, whatever
fixed order they are taken in; parts without a frequent shingle come first, then
those with more elements, as they are rarer.  (The ``FREQUENT`` most frequent
shingles are counted over all documents; they set the order and nothing else.)
Equal parts are found by a join on band, part and value.

Sets that share a part make candidates in two rounds.  The first verifies links
to the smallest set of each part only, which settles groups of copies without
their pairs.  The second takes, within parts that still join different components,
the pairs between components, sought by the sets outside the component that holds
most of the part.  Of parts held by the same sets one is looked at, pairs meet
within bands of size (a factor of 4/3, or the next), and a pair that shares several
parts is formed in the lowest of them as far as the lowest parts of either set, one
for each of ``CLASSES`` residues, tell.  A part may be a passage that very many dissimilar
sets hold.  Where more than ``FEW`` sets look for partners, they don't meet by the part but by
their rarest shingles (``rarest``, without exception; rareness comes from counts
on a table of fixed size, and any order gives all links).  In both rounds pairs whose
bit sketches (element hash modulo a power of two, parity) are too far apart go, by
a short sketch within the join and then by one of a bit for each element.
Candidates are verified on the shingles of the whole texts.  Identical sets are one
node all along: documents meet their node's component in a join in which no node
holds more than a ``HOT``-th of the rows; the nodes that do are fewer than ``HOT``
and broadcast.

A set is identified by 128 bits and goes by the first 64 of them; sets that differ
and agree in those (``clashes``) go by others.

Words are runs of characters other than ASCII white space, A-Z lower-cased.  With
fewer than five words the whole sequence is the one shingle; a null or wordless
text has no shingles and is linked with nothing.  Repeated rows share a component.
A null doc_id never is a component's id unless it has no other.  An empty table
gives no rows.  (Shingles are 64-bit hashes of whole words.)
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Set

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

WORDS = 5
#: Bytes of text hashed at once; entries kept by a task before it hands them on; entries for each bucket.
CHUNK_BYTES, HELD, BUCKET = 1 << 18, 1_000_000, 500_000
#: Entries are handed on in so many slices by bucket, as sorting and grouping take several times their room.
SLICES = 8
#: Ids of nodes that are broadcast at most; beyond that the join is left to Spark.
BROADCAST_NODES = 1_000_000
#: Nodes with more than this share of the rows are broadcast with their components; there are fewer than so many.
HOT = 1000
#: Residues of parts for which a set's lowest part is known when pairs are formed.
CLASSES = 8
#: A part in which more sets than these look for partners is a crowd, whose sets meet by their rarest shingles.
FEW = 64
#: Shingles of a crowd's sets are counted on two to the power of so many slots.
SLOTS = 20
#: 64-bit words of the short bit sketch that goes with a set's parts.
SKETCH_WORDS = 8
#: Shingles that count as frequent at most, and how often one must be among ``HELD`` shingles of a task to be counted.
FREQUENT, OFTEN = 65_536, 4
#: Sets below this size have each element as a part of its own.
SMALL = 64

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTES = np.arange(256, dtype=_U)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_TABLE = _mix(_BYTES + _U(0x9E3779B97F4A7C15))[_LOWER]
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_PLACE = _mix(np.arange(1, WORDS + 2, dtype=_U)) | _U(1)
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    """base ** 0 .. n-1, modulo 2 ** 64."""
    if len(_powers.get(name, ())) < n:
        steps = np.full(max(n, CHUNK_BYTES + 4096), base, _U)
        steps[0] = 1
        _powers[name] = np.multiply.accumulate(steps)
    return _powers[name][:n]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of the bytes ``data``."""
    blank = np.empty(len(data) + 2, bool)
    blank[0] = blank[-1] = True
    np.take(_BLANK, data, out=blank[1:-1])
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    start, end = edge[::2], edge[1::2]
    total = np.zeros(len(data) + 1, _U)
    np.cumsum(_TABLE[data] * _power("up", _BASE, len(data)), out=total[1:])
    value = (total[end] - total[start]) * _power("down", _INVERSE, len(data) + 1)[start]
    return start, _mix(value + (end - start).astype(_U))


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text (no nulls)."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1)
        yield from _chunk(data, offsets[first : last + 1])
        first = last


def _chunk(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    n = len(offsets) - 1
    # A blank byte behind each text keeps words apart.
    spaced = np.insert(data[offsets[0] : offsets[-1]], offsets[1:] - offsets[0], 32)
    bounds = offsets - offsets[0] + np.arange(n + 1)
    start, word = word_hashes(spaced)
    at = np.searchsorted(start, bounds)
    windows = np.zeros(max(0, len(word) - WORDS + 1), _U)
    for j in range(WORDS):
        windows += word[j : len(windows) + j] * _PLACE[j]
    windows = _mix(windows)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= WORDS:
            yield np.unique(windows[a : b - WORDS + 1])
        elif b > a:
            yield _mix((word[a:b] * _PLACE[: b - a]).sum(dtype=_U, keepdims=True) + np.full(1, b - a, _U) * _PLACE[WORDS])
        else:
            yield np.zeros(0, _U)


def signature(shingles: np.ndarray) -> bytes:
    """128 bits that identify a set."""
    low, high = _mix(shingles ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U), _mix(shingles ^ _U(0x14057B7EF767814F)).sum(dtype=_U)
    return np.array([low, high ^ _U(len(shingles))], _U).tobytes()


def node_of(own: bytes, clashes: Set[bytes] = frozenset()) -> int:
    """The 64-bit id that a set goes by."""
    words = np.frombuffer(own, _U)
    return int((_mix(words[1:]) if own in clashes else words[:1]).view(np.int64)[0])


def most_different(n: int, m: int) -> int:
    """How many elements similar sets of n and m elements can differ in."""
    return (n + m) // 7


def sketch(shingles: np.ndarray) -> bytes:
    """Parity of the elements at each of as many bits as there are elements, rounded up to a power of two."""
    bits = max(64, 1 << max(0, len(shingles) - 1).bit_length())
    count = np.bincount((shingles & _U(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((count & 1).astype(np.uint8)).tobytes()


def short_sketch(shingles: np.ndarray) -> list[int]:
    """Parity of the elements at each of ``SKETCH_WORDS`` * 64 bits."""
    bits = SKETCH_WORDS * 64
    count = np.bincount((shingles & _U(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((count & 1).astype(np.uint8)).view(np.int64).tolist()


def _words(packed: bytes, bits: int) -> np.ndarray:
    """A bit sketch folded to ``bits``; elements keep their place modulo that."""
    return np.bitwise_xor.reduce(np.frombuffer(packed, np.uint8).reshape(-1, bits // 8), axis=0)


def distance(a: bytes, b: bytes) -> int:
    """Hamming distance of two bit sketches: at most the size of the symmetric difference."""
    bits = 8 * min(len(a), len(b))
    return int(np.bitwise_count(_words(a, bits) ^ _words(b, bits)).sum())


def _among(shingles: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(shingles), bool)
    return frequent[np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)] == shingles


def part_keys(shingles: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The keys of a set: its first parts in every band that it belongs to.  ``frequent`` is sorted."""
    n = len(shingles)
    if not n:
        return shingles
    band = (n.bit_length() - 1) // 2
    high = 4 ** (band + 1)
    spaces = [(band, min(4 * n // 3, high - 1))]
    if 4 * n // 3 >= high:
        spaces.append((band + 1, 4 * n // 3))
    mixed, often = _mix(shingles), _among(shingles, frequent)
    out = []
    for space, largest in spaces:
        wanted = most_different(n, largest) + 1
        size = 4**space
        if size < SMALL:
            value = mixed[np.lexsort((mixed, often))[:wanted]]
        else:
            parts = size + (3 * size + 4) // 5
            part = ((shingles >> _U(32)) * _U(parts)) >> _U(32)  # in order, as the shingles are
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            count = np.diff(np.append(first, n))
            value = _mix(np.bitwise_xor.reduceat(mixed, first) + part[first] * _U(_BASE))
            value = value[np.lexsort((part[first], -count, np.logical_or.reduceat(often, first)))[:wanted]]
        out.append(_mix(value ^ np.full(1, space + 1, _U) * _PLACE[0]))
    return np.concatenate(out)


def _bodies(df: DataFrame) -> DataFrame:
    common.small_batches(df.sparkSession)
    common.small_reads(df.sparkSession)
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_of().alias("text"))


def often_held(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that stand ``OFTEN`` times or more in ``held``, sorted, and how often.  ``held`` is emptied."""
    value = np.concatenate(held)
    held.clear()
    value.sort()
    # One that stands n times is OFTEN - 1 places ahead of itself in n - OFTEN + 1 places.
    often, n = np.unique(value[: -OFTEN + 1][value[OFTEN - 1 :] == value[: -OFTEN + 1]], return_counts=True)
    return often, n + OFTEN - 1


def with_sets(df: DataFrame, clashes: Set[bytes] = frozenset()) -> DataFrame:
    """doc_id, n_shingles, node and its 128 bits, number of keys and sketches of every row; ``often``, on some rows: shingles often seen by a task and how often."""
    often = pa.list_(pa.struct([("shingle", pa.int64()), ("n", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("own", pa.binary()), ("n_keys", pa.int64()), ("short", pa.list_(pa.int64())), ("sketch", pa.binary()), ("often", often)])

    def counted(held: list[np.ndarray], rows: int) -> pa.Array:
        value, n = often_held(held)
        each = pa.StructArray.from_arrays([pa.array(value.view(np.int64)), pa.array(n.astype(np.int64))], fields=list(often.value_type))
        return pa.concat_arrays([pa.ListArray.from_arrays(pa.array([0, len(each)], pa.int32()), each, type=often), pa.nulls(rows - 1, often)])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        waiting, n = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if waiting:
                yield pa.RecordBatch.from_arrays(waiting, schema=schema)
            each = list(shingle_sets(batch.column(1)))
            rows = [(len(s), node_of(own := signature(s), clashes), own, most_different(len(s), 4 * len(s) // 3) + 1, short_sketch(s), sketch(s)) for s in each]
            waiting = [batch.column(0), *(pa.array(c, f.type) for c, f in zip(zip(*rows), list(schema)[1:])), pa.nulls(len(rows), often)]
            held += each
            n += sum(map(len, each))
            if n >= HELD:
                waiting[-1] = counted(held, len(rows))
                n = 0
        if waiting:
            if held:
                waiting[-1] = counted(held, len(waiting[0]))
            yield pa.RecordBatch.from_arrays(waiting, schema=schema)

    return _bodies(df).mapInArrow(sets, "doc_id long, n_shingles long, node long, own binary, n_keys long, short array<long>, sketch binary, often array<struct<shingle: bigint, n: bigint>>")


def frequent_shingles(sets: DataFrame, most: int = FREQUENT) -> np.ndarray:
    """At most ``most`` of the shingles that tasks often saw, the most frequent ones, sorted."""
    often = sets.where("often is not null").select(F.explode("often").alias("x")).groupBy("x.shingle").agg(F.sum("x.n").alias("n"))
    rows = often.orderBy(F.desc("n"), "shingle").limit(most).select("shingle").toArrow()
    return np.sort(rows.column(0).to_numpy().view(_U)) if rows.num_rows else np.zeros(0, _U)


_PACKED = np.dtype([("key", "<u8"), ("node", "<i8"), ("shared", "u1")])


def shared_parts(df: DataFrame, n_buckets: int, frequent: np.ndarray, clashes: Set[bytes] = frozenset()) -> DataFrame:
    """(kind, x, y): kind 1, node y holds key x, which another node holds too; kind 2, nodes x < y share a key and x is the smallest known to hold it."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, int]] = []
        n, seen = 0, set()
        for batch in batches:
            for shingles in shingle_sets(batch.column(1)):
                own = signature(shingles)
                if own in seen:
                    continue
                seen.add(own)
                key = part_keys(shingles, frequent)
                held.append((key, node_of(own, clashes)))
                n += len(key)
                if n >= HELD:
                    yield from _handed_on(held, n_buckets)
                    n, seen = 0, set()
        yield from _handed_on(held, n_buckets)

    def meet(_: tuple, group: pa.Table) -> pa.Table:
        blobs: dict[int, list[np.ndarray]] = {0: [], 1: [], 2: []}
        for kind, blob in zip(group.column("kind").to_pylist(), group.column("blob")):
            blobs[kind].append(np.frombuffer(blob.as_buffer(), "<i8").reshape(2, -1) if kind else np.frombuffer(blob.as_buffer(), _PACKED))
        entries = np.concatenate(blobs.pop(0) or [np.zeros(0, _PACKED)])
        entries = entries[np.lexsort((entries["node"], entries["key"]))]
        _, several, smallest = _groups(entries["key"], entries["node"])
        entries, smallest = entries[several], smallest[several]
        new = entries["shared"] == 0
        star = entries["node"] != smallest
        key, holder = (np.concatenate([*(pair[i] for pair in blobs[1]), more]) for i, more in enumerate((entries["key"][new].view("<i8"), entries["node"][new])))
        low, node = _distinct(*(np.concatenate([*(pair[i] for pair in blobs[2]), more]) for i, more in enumerate((smallest[star], entries["node"][star]))))
        kinds = np.repeat(np.array([1, 2], np.int8), [len(key), len(low)])
        return pa.table({"kind": pa.array(kinds), "x": pa.array(np.concatenate([key, low])), "y": pa.array(np.concatenate([holder, node]))})

    rows = _bodies(df).mapInArrow(keys, "bucket int, kind int, blob binary")
    return rows.groupBy("bucket").applyInArrow(meet, "kind byte, x long, y long")


def _groups(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For entries sorted by key and node: first of its key, whether the key has different nodes, and its smallest node."""
    if not len(key):
        return np.zeros(0, bool), np.zeros(0, bool), node
    first = np.concatenate([[True], key[1:] != key[:-1]])
    at = np.flatnonzero(first)
    size = np.diff(np.append(at, len(key)))
    smallest, largest = node[at], node[at + size - 1]
    return first, np.repeat(smallest != largest, size), np.repeat(smallest, size)


def _distinct(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs of ``x`` and ``y``, sorted."""
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    return x[new], y[new]


def _handed_on(held: list[tuple[np.ndarray, int]], n_buckets: int) -> Iterator[pa.RecordBatch]:
    """Entries by bucket, from the keys of each node; ``held`` is emptied.  Of a key that several of them hold, one goes on and the others are told at once, so that a key has an entry for each task at most.

    What is told meets nothing more and is dealt by its node, so that a key of very many nodes fills no bucket.
    """
    schema = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary())])
    if not held:
        return
    every, of = np.concatenate([k for k, _ in held]), np.repeat(np.array([v for _, v in held], np.int64), [len(k) for k, _ in held])
    held.clear()
    part = (every % _U(n_buckets) % _U(SLICES)).astype(np.uint8)
    told: list[tuple[np.ndarray, np.ndarray]] = []
    stars: list[tuple[np.ndarray, np.ndarray]] = []
    for at in range(min(SLICES, n_buckets)):
        key, node = _distinct(every[part == at], of[part == at])
        first, several, smallest = _groups(key, node)
        go = first | ~several
        entries = np.empty(int(go.sum()), _PACKED)
        entries["key"], entries["node"], entries["shared"] = key[go], node[go], several[go]
        yield from common.record_batches(_blobs(0, entries, entries["key"] % _U(n_buckets)), schema, 64)
        told.append((key[several], node[several]))
        star = several & (node != smallest)
        stars.append(_distinct(smallest[star], node[star]))
    del every, of, part
    key, holder = (np.concatenate(c) for c in zip(*told))
    yield from common.record_batches(_blobs(1, np.column_stack((key.view("<i8"), holder)), holder.view("<u8") % _U(n_buckets)), schema, 64)
    low, node = _distinct(*(np.concatenate(c) for c in zip(*stars)))
    yield from common.record_batches(_blobs(2, np.column_stack((low, node)), node.view("<u8") % _U(n_buckets)), schema, 64)


def _blobs(kind: int, parts: np.ndarray, bucket: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """(bucket, kind, blob): the ``parts`` of each bucket; of pairs, first all of one side."""
    order = np.argsort(bucket, kind="stable")
    parts, bucket = parts[order], bucket[order]
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else []
    for a, b in zip(cuts, [*cuts[1:], len(bucket)]):
        yield int(bucket[a]), kind, (np.ascontiguousarray(parts[a:b].T) if kind else parts[a:b]).tobytes()


def _shingles_of(df: DataFrame, wanted: DataFrame, nodes: DataFrame, clashes: Set[bytes]) -> DataFrame:
    """(node, shingles) of the ``wanted`` nodes, from the whole texts of one document of each."""
    chosen = common.staged(nodes.join(wanted, "node", "left_semi").select(F.col("doc_id").alias("_id")).distinct(), "chosen")
    few = chosen.count() <= BROADCAST_NODES
    texts = _bodies(df)
    texts = texts.join(F.broadcast(chosen) if few else chosen, texts["doc_id"].eqNullSafe(chosen["_id"]), "left_semi")
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for s in shingle_sets(batch.column(1)):
                    yield node_of(signature(s), clashes), s.tobytes()

        yield from common.record_batches(rows(), schema, 256)

    each = texts.mapInArrow(sets_of, "node long, shingles binary")
    return each.join(wanted, "node", "left_semi").dropDuplicates(["node"])


_WORDS, _LOWS = [f"w{i}" for i in range(SKETCH_WORDS)], [f"low{i}" for i in range(CLASSES)]
#: The sizes and the short sketches of two sets allow that they are similar.
_MAY = f"4 * least(n_a, n_b) >= 3 * greatest(n_a, n_b) and 7 * ({' + '.join(f'bit_count({w}_a ^ {w}_b)' for w in _WORDS)}) <= n_a + n_b"
#: Sets of sizes within 4/3 stand in the same band or in neighbours, whatever the logarithm is rounded to.
_BAND = 4 / 3 + 1e-4
#: No lower part is known that both hold.
_FIRST = " and ".join(f"not ({k}_a <=> {k}_b and coalesce({k}_a < key_a, false))" for k in _LOWS)


def _side(df: DataFrame, side: str, *columns: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{c}_{side}") for c in columns])


def _close(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) whose long sketches allow that they are similar."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [distance(p, q) <= most for p, q, most in zip(*(batch.column(c).to_pylist() for c in ("sketch_a", "sketch_b", "most")))]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], schema=schema).filter(pa.array(ok, pa.bool_()))

    a, b = (_side(nodes, s, "node", "n", "sketch") for s in "ab")
    met = pairs.join(a, F.col("a") == F.col("node_a")).join(b, F.col("b") == F.col("node_b"))
    return met.select("a", "b", "sketch_a", "sketch_b", F.expr("(n_a + n_b) div 7").alias("most")).mapInArrow(close, "a long, b long")


def _similar(df: DataFrame, pairs: DataFrame, nodes: DataFrame, clashes: Set[bytes], held: DataFrame | None = None) -> DataFrame:
    """The ``pairs`` (a, b) of nodes that are similar, by their shingles (those ``held``, or read again)."""
    pairs = common.staged(_close(pairs, nodes), "candidates")
    if held is None:
        wanted = pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")).distinct()
        held = common.staged(_shingles_of(df, wanted, nodes, clashes), "shingles")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for p, q in zip(batch.column("shingles_a"), batch.column("shingles_b")):
                x, y = np.frombuffer(p.as_buffer(), _U), np.frombuffer(q.as_buffer(), _U)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= 75 * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], schema=schema).filter(pa.array(ok, pa.bool_()))

    a, b = (_side(held, s, "node", "shingles") for s in "ab")
    met = pairs.join(a, F.col("a") == F.col("node_a")).join(b, F.col("b") == F.col("node_b"))
    return common.staged(met.select("a", "b", "shingles_a", "shingles_b").mapInArrow(similar, "a long, b long"), "verified")


def open_parts(holds: DataFrame) -> DataFrame:
    """The (key, node, root) of ``holds`` whose key joins different roots; of keys with the same nodes, one."""
    number = F.xxhash64("node", F.lit(1))
    each = holds.groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("m"),
        F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("total"), F.bit_xor(number).alias("parity"),
    )
    one = each.where("low <> high").groupBy("m", "total", "parity").agg(F.min("key").alias("key")).select("key")
    return common.staged(holds.join(one, "key", "left_semi"), "open-parts")


def _slot(shingles: np.ndarray) -> np.ndarray:
    return (_mix(shingles ^ _U(0x2545F4914F6CDD1D)) >> _U(64 - SLOTS)).astype(np.int64)


def slot_counts(held: DataFrame) -> np.ndarray:
    """How many shingles of all sets (node, shingles) fall on each of 2 ** ``SLOTS`` slots."""
    schema = pa.schema([("slot", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOTS, np.int64)
        for batch in batches:
            for s in batch.column("shingles"):
                slots, n = np.unique(_slot(np.frombuffer(s.as_buffer(), _U)), return_counts=True)
                total[slots] += n
        used = np.flatnonzero(total)
        for at in range(0, len(used), 65_536):
            some = used[at : at + 65_536]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], schema=schema)

    rows = held.mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << SLOTS, np.int64)
    out[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return np.minimum(out, np.iinfo(np.uint32).max).astype(np.uint32)


def rarest(shingles: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int]:
    """The shingles of a set, rarest first, by which a similar set is found, and how many of them a set must show to one that is no smaller.

    Of similar sets of n <= m shingles the first lacks at most n / 7 of the second's, the second at most m / 4 of the first's.
    In one order of all shingles they therefore share one of the first n // 7 + 1 of the first and the first m // 4 + 1 of the second.
    """
    n = len(shingles)
    order = np.lexsort((shingles, counts[_slot(shingles)]))
    return shingles[order[: n // 4 + 1]], n // 7 + 1


def _with_main(rows: DataFrame) -> DataFrame:
    """``rows`` (key, node, root, ...) with ``main``, whether a node is of the root that most holders of its key have, and ``others``, how many holders are not.

    Of two nodes with different roots one at least isn't of the main one, so only
    such nodes need to look for partners: a large group's nodes never meet each other.
    """
    held = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("m"))
    held = held.groupBy("key").agg(F.max_by("root", F.struct("m", "root")).alias("main"), F.max("m").alias("most"), F.sum("m").alias("m"))
    held = common.staged(held.select("key", "main", (F.col("m") - F.col("most")).alias("others"), "m"), "mains")
    return looked_up(rows, held, "key", "m", rows.count()).withColumn("main", F.col("root") == F.col("main"))


def _between(parts: DataFrame, short: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes with different roots that share one of ``parts`` (key, node, root) and may be similar; those that are not ``main`` look for partners, so few of a part should not be.

    ``main`` is found where ``parts`` come without it.
    """
    if "main" not in parts.columns:
        parts = _with_main(parts).drop("others")
    lows = parts.groupBy("node").agg(*[F.min(F.when(F.pmod("key", F.lit(CLASSES)) == i, F.col("key"))).alias(k) for i, k in enumerate(_LOWS)])
    each = common.staged(parts.join(short, "node").join(lows, "node").withColumn("band", F.floor(F.log(F.col("n").cast("double")) / math.log(_BAND)).cast("int")), "between")
    near = F.explode(F.array(F.col("band") - 1, "band", F.col("band") + 1))
    a = _side(each.where("not main").withColumn("band", near), "a", "key", "band", "node", "root", "n", *_WORDS, *_LOWS)
    b = _side(each, "b", "key", "band", "node", "root", "main", "n", *_WORDS, *_LOWS)
    once = "(main_b or n_a < n_b or n_a = n_b and node_a < node_b)"
    met = a.join(b, F.expr(f"key_a = key_b and band_a = band_b and {once} and root_a <> root_b and {_MAY} and {_FIRST}"))
    return met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def _between_many(held: DataFrame, crowd: DataFrame, short: DataFrame) -> DataFrame:
    """Pairs (a, b) of the ``crowd`` (node, root) with different roots that may be similar, of sets ``held`` (node, shingles).

    Sets that share a part need not be alike: where a passage stands in very many of them,
    all hold its parts.  They meet by their rarest shingles: sets that are too different for a link have as many rare ones of their own.
    """
    counts = held.sparkSession.sparkContext.broadcast(slot_counts(held))
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("shown", pa.bool_())])

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [rarest(np.frombuffer(s.as_buffer(), _U), counts.value) for s in batch.column("shingles")]
            if each:
                size = [len(few) for few, _ in each]
                key, node = np.concatenate([few for few, _ in each]).view(np.int64), np.repeat(batch.column("node").to_numpy(), size)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(node), pa.array(np.concatenate([np.arange(n) < shown for n, (_, shown) in zip(size, each)]))], schema=schema)

    rows = common.staged(held.mapInArrow(tokens, "key long, node long, shown boolean").join(crowd, "node"), "rare-shingles")
    # A shingle of one component joins nothing.
    several = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("m")).where("low <> high").select("key")
    rows = common.staged(rows.join(several, "key", "left_semi"), "shared-shingles")
    each = common.staged(_with_main(rows).drop("others").join(short, "node"), "between")
    a = _side(each.where("not main"), "a", "key", "node", "root", "shown", "n", *_WORDS)
    b = _side(each, "b", "key", "node", "root", "shown", "main", "n", *_WORDS)
    once = "(main_b or node_a < node_b)"
    seen = "(n_a >= n_b and shown_b or n_b >= n_a and shown_a)"
    met = a.join(b, F.expr(f"key_a = key_b and {once} and root_a <> root_b and {seen} and {_MAY}"))
    return met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def linked(df: DataFrame, sets: DataFrame, nodes: DataFrame, clashes: Set[bytes] = frozenset()) -> tuple[DataFrame, DataFrame]:
    """Verified links (a, b) between nodes that connect all similar sets, and (node, root) of their components."""
    total = sets.agg(F.sum("n_keys").alias("n")).first().n or 0
    shared = common.staged(shared_parts(df, max(1, -(-int(total) // BUCKET)), frequent_shingles(sets), clashes), "parts")
    short = nodes.select("node", "n", *_WORDS)
    stars = shared.where("kind = 2").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
    a, b = (_side(short, s, *short.columns) for s in "ab")
    stars = stars.join(a, F.col("a") == F.col("node_a")).join(b, F.col("b") == F.col("node_b")).where(_MAY).select("a", "b")
    links = _similar(df, stars, nodes, clashes)
    roots = components(links)
    holds = shared.where("kind = 1").select(F.col("x").alias("key"), F.col("y").alias("node")).distinct()
    holds = holds.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    parts = common.staged(_with_main(open_parts(holds)), "main-parts")
    more = _similar(df, _between(parts.where(F.col("others") <= FEW).drop("others"), short), nodes, clashes)
    crowd = common.staged(parts.where(F.col("others") > FEW).select("node", "root").distinct(), "crowd")
    if not crowd.isEmpty():
        held = common.staged(_shingles_of(df, crowd.select("node"), nodes, clashes), "crowd-shingles")
        more = more.unionAll(_similar(df, _between_many(held, crowd, short), nodes, clashes, held))
    if more.isEmpty():
        return links, roots
    links = links.unionAll(more)
    return links, components(links)


def _nodes(sets: DataFrame) -> DataFrame:
    """One row for each node: its size, sketches, rows, lowest doc_id, and whether different sets go by its id."""
    each = sets.groupBy("node").agg(
        F.any_value("n_shingles").cast("int").alias("n"), F.any_value("short").alias("short"), F.any_value("sketch").alias("sketch"),
        F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("doc_id"), (F.min("own") != F.max("own")).alias("clash"),
    )
    return each.select("node", "n", "sketch", "rows", "doc_id", "clash", *[F.get("short", i).alias(w) for i, w in enumerate(_WORDS)])


def _identified(df: DataFrame) -> tuple[DataFrame, DataFrame, Set[bytes]]:
    """The sets of all rows, their nodes, and the sets that don't go by their first 64 bits as another one does."""
    clashes: Set[bytes] = frozenset()
    while True:
        sets = common.staged(with_sets(df, clashes), "sets")
        nodes = common.staged(_nodes(sets.where("n_shingles > 0")), "nodes")
        again = nodes.where("clash").select("node")
        # So few that they are named: n sets have about n * n / 2 ** 65 of them.
        own = sets.join(again, "node", "left_semi").select("own").distinct().collect() if not again.isEmpty() else []
        if not own:
            return sets, nodes, clashes
        clashes |= {bytes(r.own) for r in own}


def looked_up(rows: DataFrame, table: DataFrame, key: str, n: str, total: int) -> DataFrame:
    """``rows`` with the other columns of ``table`` (a row for each ``key``, ``n`` of the rows have it), null where it has none.

    Keys of more than a ``HOT``-th of the ``total`` rows are fewer than ``HOT`` and are
    broadcast; the join deals the others, of which none fills a task.
    """
    values, most = [c for c in table.columns if c not in (key, n)], -(-total // HOT)
    hot = F.broadcast(table.where(F.col(n) > most).select(key, F.struct(*values).alias("hot")))
    near = rows.join(hot, key, "left")
    rest = near.where("hot is null").drop("hot").join(table.where(F.col(n) <= most).drop(n), key, "left")
    return rest.select(*rows.columns, *values).unionAll(near.where("hot is not null").select(*rows.columns, "hot.*"))


def placed(df: DataFrame) -> tuple[DataFrame, Set[bytes]]:
    """doc_id, n_shingles, node, root and component_id of every row of ``df`` (doc_id, text); and the ``clashes``."""
    sets, nodes, clashes = _identified(df)
    _, roots = linked(df, sets.where("n_shingles > 0"), nodes, clashes)
    rooted = nodes.select("node", "rows", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = common.staged(rooted.groupBy("root").agg(F.min("doc_id").alias("lowest"), F.count(F.lit(1)).alias("members")), "lowest")
    met = looked_up(rooted, lowest, "root", "members", nodes.count())
    # A node of its own with one row needs no join.
    where = common.staged(met.where("rows > 1 or not lowest <=> doc_id or root <> node").select("node", "root", "lowest", "rows"), "components")
    rows = sets.select("doc_id", "n_shingles", "node")
    every = looked_up(rows, where, "node", "rows", rows.count())
    own = F.when(F.col("n_shingles") > 0, F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("lowest"))).otherwise(F.col("doc_id"))
    return every.select("doc_id", "n_shingles", "node", F.coalesce("root", "node").alias("root"), own.alias("component_id")), clashes


def joined(df: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``df`` (doc_id, text)."""
    return placed(df)[0].select("doc_id", "n_shingles", "component_id")


def kept_rows(df: DataFrame) -> DataFrame:
    """One row of ``df`` (doc_id, text, ...) for each component; wordless texts stay, but for repeated rows.

    The row with the smallest doc_id stays.  Rows without a doc_id go by a number
    hashed from their text, which stands behind every id.  Where a doc_id stands on
    several rows, each goes or stays by its own text.  Columns of any name pass.
    """
    row = df.select(common.row_of(df).alias("row"))
    doc_id, text = F.col("row.doc_id").cast("long"), common.text_of("row.text")
    by_text = F.shiftrightunsigned(F.xxhash64(text), 2).bitwiseOR(F.lit(1 << 62))
    named = row.select("row", F.coalesce(doc_id, by_text).alias("id"), text.alias("text"))
    found, clashes = placed(named.select(F.col("id").alias("doc_id"), "text"))
    found = common.staged(found, "joined")
    again = common.staged(found.groupBy(F.col("doc_id").alias("id")).count().where("count > 1").select("id"), "repeated-ids")
    out = found.where("doc_id <> component_id").select(F.col("doc_id").alias("id"))
    once = named.join(out.unionAll(again).distinct(), "id", "left_anti").select("row")
    # Of rows that share an id: those that are the first of their component.
    twice = found.join(again.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi").where("doc_id = component_id")
    stay = twice.where("n_shingles > 0").groupBy("root", "doc_id").agg(F.min("node").alias("node")).select(F.col("doc_id").alias("id"), "node")
    stay = stay.unionAll(twice.where("n_shingles = 0").select("doc_id", "node")).distinct()
    repeated = named.join(again, "id", "left_semi").withColumn("tag", F.xxhash64("text"))
    nodes = with_sets(repeated.select(F.col("tag").alias("doc_id"), "text").dropDuplicates(["doc_id"]), clashes).select(F.col("doc_id").alias("tag"), "node")
    first = repeated.join(nodes, "tag").join(stay, ["id", "node"], "left_semi").dropDuplicates(["id", "node"])
    return once.unionAll(first.select("row")).select("row.*")
