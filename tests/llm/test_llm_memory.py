"""What a task of the n-gram join holds beside its texts and keys stays small, and nothing is lost by that."""

import tracemalloc
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pyarrow as pa
from fluvia.llm import jaccard


def peak_of(run) -> float:
    """MB that ``run`` takes at most beyond what was there."""
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def some_keys(n_nodes: int, n_keys: int, n_common: int) -> list[tuple[np.ndarray, int]]:
    rng = np.random.default_rng(3)
    common = rng.integers(0, 1 << 63, n_common, dtype=np.uint64)
    return [(np.concatenate([rng.integers(0, 1 << 63, n_keys - n_keys // 4, dtype=np.uint64), rng.choice(common, n_keys // 4)]), int(node)) for node in rng.integers(-(1 << 62), 1 << 62, n_nodes)]


def test_keys_are_handed_on_in_little_room():
    held = some_keys(jaccard.HELD // 170, 170, 60_000)
    assert peak_of(lambda: [None for _ in jaccard._handed_on(held, 88)]) < 60
    assert not held


def test_texts_are_hashed_in_little_room():
    texts = pa.array([f"text {k} " + " ".join(f"w{k * j % 5003}" for j in range(1000)) for k in range(700)])
    assert peak_of(lambda: [None for _ in jaccard.shingle_sets(texts)]) < 22


def test_every_key_is_handed_on():
    for n_buckets in (1, 3, 17):
        held = some_keys(200, 40, 150)
        nodes = defaultdict(set)
        for keys, node in held:
            for key in keys.tolist():
                nodes[key].add(node)
        got = {0: [], 1: [], 2: []}
        for batch in jaccard._handed_on(held, n_buckets):
            for bucket, kind, blob in zip(*(c.to_pylist() for c in batch.columns)):
                rows = np.frombuffer(blob, "<i8").reshape(2, -1).T.tolist() if kind else np.frombuffer(blob, jaccard._PACKED).tolist()
                assert all((row[1] if kind else row[0]) % 2**64 % n_buckets == bucket for row in rows)
                got[kind] += map(tuple, rows)
        assert sorted(got[0]) == sorted((key, min(of), len(of) > 1) for key, of in nodes.items())
        assert sorted(got[1]) == sorted((key, node) for key, of in nodes.items() if len(of) > 1 for node in of)
        assert sorted(got[2]) == sorted({(min(of), node) for of in nodes.values() for node in of if node != min(of)})


def test_often_held_shingles_are_counted():
    rng = np.random.default_rng(4)
    held = [rng.integers(0, 300, rng.integers(0, 90)).astype(np.uint64) for _ in range(12)]
    want = {k: n for k, n in Counter(np.concatenate(held).tolist()).items() if n >= jaccard.OFTEN}
    value, n = jaccard.often_held(held)
    assert want and dict(zip(value.tolist(), n.tolist())) == want and (np.diff(value.astype(np.int64)) > 0).all() and not held
    assert not len(jaccard.often_held([np.arange(2, dtype=np.uint64)])[0])


def test_readers_decode_few_texts_at_once(spark, odd_documents):
    for name, stage in corpus_pipeline.STAGES[:2]:
        spark.conf.unset("spark.sql.parquet.columnarReaderBatchSize")
        stage(spark, odd_documents, "")
        assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 512, name
    spark.conf.unset("spark.sql.parquet.columnarReaderBatchSize")
