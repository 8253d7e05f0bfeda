"""Operator 1: best-fit packing by minimum bin slack.

Documents become token ids plus one separator.  Those longer than a sequence are
cut into full sequences, the rest coming first.  The pieces are dealt evenly
into buckets of about ``BUCKET`` pieces (their number grows with the input, so no
task or driver sees all of them); a bucket is packed from its histogram of
lengths: the longest piece left opens a sequence, a subset-sum dynamic programme
over a bitset of reachable totals finds the fullest combination of the lengths
that are left, and the combination is removed as often as the counts allow.

Null texts are empty: one piece with the separator alone.  Texts of any length are
tokenized whole and cut into as many pieces as it takes.  Repeated rows are packed
each on its own; an empty table gives an empty result; further columns are ignored.
Of pieces of equal length any may go first; of combinations of equal totals the one
with the longest pieces does.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, tokens

CAPACITY, SEPARATOR, BUCKET = 2048, 0, 16_384

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACES = f"{_PIECES}, sequence_id long, offset long"


def minimum_bin_slack(counts: dict[int, int], capacity: int) -> Iterator[tuple[Counter, int]]:
    """(lengths of one bin, number of such bins) until nothing is left."""
    left = {length: n for length, n in sorted(counts.items(), reverse=True) if n}
    while left:
        seed = next(iter(left))
        combination = Counter({seed: 1})
        combination.update(fullest({k: n - (k == seed) for k, n in left.items()}, capacity - seed))
        times = min(left[k] // n for k, n in combination.items())
        for k, n in combination.items():
            left[k] -= times * n
            if not left[k]:
                del left[k]
        yield combination, times


def fullest(counts: dict[int, int], room: int) -> Counter:
    """The combination of lengths, longest first, with the largest total within ``room``."""
    mask, bits, trail = (1 << (room + 1)) - 1, 1, []
    for length, n in counts.items():
        n, step = min(n, room // length), 1
        while n > 0:
            step = min(step, n)
            grown = bits | (bits << (step * length)) & mask
            if grown != bits:
                trail.append((length, step, bits))
                bits = grown
            n, step = n - step, step * 2
        if bits >> room & 1:
            break
    total, used = bits.bit_length() - 1, Counter()
    for length, step, before in reversed(trail):
        if not before >> total & 1:
            used[length] += step
            total -= step * length
    return used


def tokenized(df: DataFrame, capacity: int = CAPACITY, separator: int = SEPARATOR, ranks: str | None = None, keep_ids: bool = False) -> DataFrame:
    """A row for each piece, with its ids (little-endian unsigned 32-bit) if asked for."""
    ranks = ranks or tokens.default_ranks()
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * keep_ids)
    end = np.array([separator], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.codec(ranks).encode

        def rows():
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    ids = encode(text.as_py()) + end
                    n = len(ids) // 4
                    at, k = 0, 0
                    cut = (n - 1) % capacity + 1
                    while at < n:
                        part = ids[4 * at : 4 * cut]
                        yield (doc_id, k, at, cut - at, zlib.crc32(part)) + ((part,) if keep_ids else ())
                        at, k, cut = cut, k + 1, cut + capacity

        yield from common.record_batches(rows(), schema, 512 if keep_ids else 4096)

    common.small_batches(df.sparkSession)
    out = _PIECES + ", ids binary" * keep_ids
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_of().alias("text")).mapInArrow(pieces, out)


def packed(pieces: DataFrame, capacity: int = CAPACITY, bucket: int = BUCKET) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``.  ``pieces`` should be a written table."""
    n_buckets = max(1, math.ceil(pieces.count() / bucket))
    has_ids = "ids" in pieces.columns

    def place(key: tuple, group: pa.Table) -> pa.Table:
        length = group.column("length").to_numpy()
        order = np.argsort(length, kind="stable")
        waiting: dict[int, list[int]] = defaultdict(list)
        for row in order[::-1].tolist():
            waiting[int(length[row])].append(row)
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        number = key[0].as_py() << 32
        for combination, times in minimum_bin_slack({k: len(v) for k, v in waiting.items()}, capacity):
            for _ in range(times):
                at = 0
                for size, n in combination.items():
                    for _ in range(n):
                        row = waiting[size].pop()
                        sequence[row], offset[row] = number, at
                        at += size
                number += 1
        return group.drop_columns(["bucket"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    dealt = pieces.withColumn("bucket", F.pmod(F.monotonically_increasing_id(), F.lit(n_buckets)))
    out = _PIECES + ", ids binary" * has_ids + ", sequence_id long, offset long"
    return dealt.groupBy("bucket").applyInArrow(place, out)


def pack_documents(df: DataFrame, capacity: int = CAPACITY, separator: int = SEPARATOR, ranks: str | None = None, keep_ids: bool = False) -> DataFrame:
    """``df`` (doc_id, text) as pieces placed in sequences of at most ``capacity`` ids."""
    return packed(common.staged(tokenized(df, capacity, separator, ranks, keep_ids), "pieces"), capacity)
