"""Columns whose names clash with those made on the way, and odd rows, for every operator that passes rows on."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fluvia.llm import common, jaccard, mixing, pii, rules

CLASHING = ["_c", "_p", "_id", "id", "_old", "rate", "copy", "n-x", "a.b", "row", "body", "counts", "kept", "_row", "_t", "new", "node", "tag", "place", "shuffle_key", "of", "k"]


@pytest.fixture
def wide(spark, odd_documents):
    """``odd_documents`` and a clean text, with columns of clashing names and different types."""
    clean = " ".join("".join(chr(97 + (7 * k + 3 * j) % 26) for j in range(3 + k % 5)) for k in range(130))
    more = spark.createDataFrame([(8, clean, "en", "a", len(clean)), (9, "mail x@y.com now " + clean[::-1], "en", "b", 1)], odd_documents.schema)
    df = odd_documents.unionByName(more)
    return df.select("*", *[(F.lit("mine") if k % 2 else F.array(F.struct(F.lit(k).alias("q")))).alias(c) for k, c in enumerate(CLASHING)])


def _same_columns(got, wide):
    assert got.columns == wide.columns and [f.dataType for f in got.schema] == [f.dataType for f in wide.schema]
    mine = [F.col(common.quoted(c)) for k, c in enumerate(CLASHING) if k % 2]
    assert {v for r in got.select(*mine).collect() for v in r} <= {"mine"}
    return got.select("doc_id", "text", "n_chars").collect()


def test_rules_jaccard_and_pii_pass_every_column(wide, monkeypatch):
    monkeypatch.setattr(rules, "KEEP", 0.0)  # all but those that fail the base limits
    assert {8} <= {r.doc_id for r in _same_columns(rules.kept_rows(wide), wide)} <= {4, 5, 8, 9}
    left = _same_columns(jaccard.kept_rows(wide), wide)
    assert Counter(r.doc_id for r in left) == Counter([1, 2, None, 4, 6, 8, 9])
    masked = {r.doc_id: r for r in _same_columns(pii.redacted(wide, length="n_chars"), wide)}
    assert masked[9].text.startswith("mail <email> now ") and masked[9].n_chars == len(masked[9].text) and masked[5].n_chars is None and masked[2].text is None


def test_mixing_passes_every_column(wide):
    with pytest.raises(ValueError, match="copy"):
        mixing.mixed(wide)
    number, key = common.free_names(wide, "copy", "shuffle_key")
    got = mixing.mixed(wide, number=number, key=key, epochs=3.0)
    assert got.columns == [*wide.columns, "_copy", "_shuffle_key"] and got.count() > 0


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stages_return_the_columns_they_got(spark, wide, stage):
    _same_columns(stage[1](spark, wide, ""), wide)


def test_a_doc_id_on_different_texts_loses_no_component(spark):
    x, y = (" ".join(f"{c}{k}" for k in range(60)) for c in "xy")
    df = spark.createDataFrame([(3, x + " more"), (5, x), (5, y), (7, y + " more"), (7, y + " more"), (None, ""), (None, None), (8, " ")], "doc_id long, text string")
    got = Counter((r.doc_id, (r.text or "")[:1]) for r in jaccard.kept_rows(df).collect())
    assert got == Counter({(3, "x"): 1, (5, "y"): 1, (None, ""): 1, (8, " "): 1})


def test_sets_that_agree_in_their_first_bits_are_told_apart(spark, docs_small, monkeypatch):
    want = Counter(tuple(r) for r in jaccard.joined(docs_small).collect())
    sets = jaccard._identified(docs_small)[0].select("own").distinct().limit(40).collect()
    clashes = frozenset(bytes(r.own) for r in sets)
    with_sets = jaccard.with_sets
    # The first pass takes the clashing sets for one node.
    monkeypatch.setattr(jaccard, "with_sets", lambda df, known=frozenset(): with_sets(df, known) if known else with_sets(df).withColumn("node", F.when(F.col("own").isin([bytearray(c) for c in clashes]), 7).otherwise(F.col("node"))))
    _, _, found = jaccard._identified(docs_small)
    assert found == clashes
    assert Counter(tuple(r) for r in jaccard.joined(docs_small).collect()) == want


@pytest.fixture
def docs_small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")


def test_pairs_between_components_of_shared_parts(spark):
    rng = random.Random(5)
    node = {k: (rng.choice([0, 0, 0, *range(1, 9)]), rng.randint(60, 140), [rng.getrandbits(2) for _ in range(jaccard.SKETCH_WORDS)]) for k in range(1, 121)}
    held = {(key, k) for key in range(-6, 20) for k in rng.sample(sorted(node), rng.choice([2, 8, 60]))}
    parts = spark.createDataFrame([(key, k, node[k][0]) for key, k in sorted(held)], "key long, node long, root long")
    short = spark.createDataFrame([(k, n, *words) for k, (_, n, words) in node.items()], ", ".join(["node long, n int", *[f"w{i} long" for i in range(jaccard.SKETCH_WORDS)]]))
    want = set()
    for a, b in itertools.combinations(sorted(node), 2):
        (ra, na, wa), (rb, nb, wb) = node[a], node[b]
        apart = sum((x ^ y).bit_count() for x, y in zip(wa, wb))
        if ra != rb and 4 * min(na, nb) >= 3 * max(na, nb) and 7 * apart <= na + nb and any((k, a) in held and (k, b) in held for k in range(-6, 20)):
            want.add((a, b))
    got = jaccard._between(parts, short).collect()
    assert len(got) == len(want) > 500 and {tuple(r) for r in got} == want


def test_a_group_of_two_thousand_near_copies(spark):
    import random

    rng = random.Random(11)
    base = [f"w{k}" for k in range(80)]
    rows = [(k, " ".join(f"z{rng.randrange(9)}" if rng.random() < 0.02 else w for w in base)) for k in range(2000)]
    rows += [(k, " ".join(f"u{k}_{j}" for j in range(30)) + " " + " ".join(base[:50])) for k in range(2000, 2100)]
    rows += [(k, "one and the same copy of a text that is found very often") for k in range(3000, 4500)]
    got = Counter(tuple(r) for r in jaccard.joined(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute(rows)


def brute(rows):
    import numpy as np

    sets = []
    for _, text in rows:
        w = text.split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)})
    number = {s: k for k, s in enumerate(sorted({x for s in sets for x in s}))}
    m = np.zeros((len(rows), len(number)), np.float32)
    for row, s in zip(m, sets):
        row[[number[x] for x in s]] = 1
    both, size = m @ m.T, m.sum(1)
    link = 100 * both >= 75 * (size[:, None] + size - both)
    root = np.arange(len(rows))
    while True:
        low = np.array([root[row].min() for row in link])
        if (low == root).all():
            return Counter((i, len(s), rows[r][0]) for (i, _), s, r in zip(rows, sets, root))
        root = low
