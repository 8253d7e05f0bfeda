import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from fluvia.llm import jaccard, mixing, packing, pii, quality, queries, rules, tokencount, tokens, urls, vectors, warc
from oracle import same

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    same(queries.queries()[name](spark, DIR), DIR, queries.oracle_sql()[name])


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")


def _tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_the_tokenizers(docs):
    random.seed(1)
    parts = ["a", " ", "  ", "\n", "\t", ",", ".", "1", "'s", "é", "<|endoftext|>", "!!", "x\ny", "日本", "\r\n", "word"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 12))) for _ in range(5000)] + [r.text or "" for r in docs.collect()]
    encode = tokens.codec(tokens.default_ranks()).encode
    for text, want in zip(texts, _tokenizer().encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(encode(text), "<u4").tolist() == want.ids


def test_packing(spark, docs, odd_documents):
    special = spark.createDataFrame([(1, "a<|endoftext|> b"), (2, "<|endoftext|>"), (3, "<|endoftext|><|endoftext|>\n" * 900)], "doc_id long, text string")
    for df in (docs, odd_documents, special, docs.limit(0)):
        rows = packing.pack_documents(df).collect()
        known = [(r.doc_id, r.text or "") for r in df.collect()]
        want = Counter()
        for (doc_id, _), ids in zip(known, _tokenizer().encode_batch([t for _, t in known], add_special_tokens=False)):
            ids, at, k = [*ids.ids, 0], 0, 0
            while at < len(ids):
                n = (len(ids) - 1) % 2048 + 1 if not k else 2048
                want[(doc_id, k, at, n, zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes()))] += 1
                at, k = at + n, k + 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
        spans = defaultdict(list)
        for r in rows:
            spans[r.sequence_id].append((r.offset, r.length))
        for places in spans.values():
            end = 0
            for offset, length in sorted(places):
                assert offset == end
                end += length
            assert end <= packing.CAPACITY
        total = sum(r.length for r in rows)
        assert len(spans) <= 1.05 * -(-total // packing.CAPACITY) + 1


def test_fullest_is_the_best_sum():
    random.seed(2)
    for _ in range(100):
        counts = Counter(random.choices(range(1, 30), k=8))
        room = random.randint(1, 60)
        sums = {0}
        for length, n in counts.items():
            sums = {s + k * length for s in sums for k in range(n + 1)}
        used = packing.fullest(dict(sorted(counts.items(), reverse=True)), room)
        assert sum(k * n for k, n in used.items()) == max(s for s in sums if s <= room)
        assert all(n <= counts[k] for k, n in used.items())


def test_token_counts(spark, docs, odd_documents):
    for df, block in ((docs, 1000), (odd_documents, 64)):
        got = Counter((r.doc_id, r.n_tokens) for r in tokencount.count_tokens(df, block=block).collect())
        rows = df.collect()
        plain = _tokenizer()
        plain.encode_special_tokens = True  # the end id stands between documents only
        ids = plain.encode_batch([r.text or "" for r in rows], add_special_tokens=False)
        assert got == Counter((r.doc_id, len(i.ids)) for r, i in zip(rows, ids))
    assert tokencount.count_tokens(docs.limit(0)).count() == 0


def test_warc_round_trip_in_small_ranges(spark, tmp_path):
    rows = [(1, "http://a/b c", "x" * 200), (2, None, "x" * 200), (3, "u", None), (4, "u", ""), (5, "u", "é" * 90), (None, "u", "z" * 150), (1, "http://a/b c", "x" * 200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = f"file://{tmp_path}/warc"
    warc.write_warc(pages, path)
    got = warc.read_warc(spark, path, range_bytes=37).collect()
    assert Counter((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in got) == Counter({(1, "response", None, 200): 2, (2, "revisit", 1, 200): 1, (3, "response", None, 0): 1, (4, "response", None, 0): 1, (5, "response", None, 180): 1, (None, "response", None, 150): 1})
    assert all(r.intact for r in got)
    assert warc.archived(pages.limit(0)).count() == 0


def test_warc_keeps_long_urls_and_counts_records(spark, monkeypatch, tmp_path):
    noise = "".join(random.Random(9).choices("abcdefghijklmnopqrstuvwxyz0123456789", k=100_000))
    rows = [(1, "u" * 100_000, "x" * 200), (2, noise, "x" * 200), (3, noise, "y"), (4, "u", "z" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.url, r.payload_bytes, r.intact) for r in warc.archived(pages).collect()}
    assert got == {k: (u, len(h), True) for k, u, h in rows}
    path = f"file://{tmp_path}/warc"
    warc.write_warc(pages, path)
    assert sorted(r.page_id for r in warc.read_warc(spark, path, range_bytes=1000).collect()) == [1, 2, 3, 4]
    read = warc.read_warc
    monkeypatch.setattr(warc, "read_warc", lambda *a, **k: read(*a, **k).where("page_id <> 3"))
    with pytest.raises(RuntimeError, match="3 records read, 4 written"):
        warc.archived(pages)


def test_urls_without_a_host(spark):
    pages = spark.createDataFrame([(1, None), (2, "nohost"), (3, "http://EXAMPLE.com/en/7x?q"), (4, "http://a.ads.org/fr/")], "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judged(pages).collect()}
    assert got == {1: ("", "", None, "allow"), 2: ("", "", None, "allow"), 3: ("example.com", "/en/7x", "example.com/en/7", "allow"), 4: ("a.ads.org", "/fr/", None, "block")}
    assert urls.judged(pages.limit(0)).count() == 0


def test_vectors(spark):
    df = spark.read.parquet(f"{DIR}/embeddings.parquet")
    odd = spark.createDataFrame([(9001, None, 1), (9002, [0.0] * 3, 1), (9003, [float("nan")] * 3, 1), (9004, [1.0, 2.0, 3.0], None), (9005, [1.0, 2.0, 3.0], 3), (9006, [1.0, 2.0, 3.0], 3), (9007, [2.0, 4.0, 6.0], 3)], df.schema)
    rows = df.unionByName(odd).collect()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.deduplicated(df.unionByName(odd), shard=64).collect()}
    links = Counter()
    for a in rows:
        for b in rows:
            if a.vec_id != b.vec_id and a.label is not None and a.label == b.label and a.embedding and b.embedding and len(a.embedding) == len(b.embedding):
                x, y = np.array(a.embedding, float), np.array(b.embedding, float)
                n = np.linalg.norm(x) * np.linalg.norm(y)
                links[a.vec_id] += bool(n > 0 and x @ y / n >= 0.93)
    assert sum(v[0] for v in got.values()) >= 0.9 * sum(links.values())
    assert all(v[0] <= links[k] for k, v in got.items())
    assert got[9001] == (0, 9001, True) and got[9003] == (0, 9003, True) and got[9007] == (2, 9005, False)
    assert vectors.audit(df) >= 0.9
    assert vectors.deduplicated(df.limit(0)).count() == 0


def _near(rng, centre, n, cosine):
    """n unit vectors around ``centre`` with about this cosine between two of them."""
    side = rng.normal(size=(n, len(centre)))
    side -= np.outer(side @ centre, centre)
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    return np.sqrt(cosine) * centre + np.sqrt(1 - cosine) * side


def _unit(x):
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def test_asked_cells_hold_every_vector_in_range():
    rng = np.random.default_rng(5)
    for dim in (2, 5, 64):
        centres, x = _unit(rng.normal(size=(12, dim))), _unit(rng.normal(size=(300, dim)))
        x = np.concatenate([x, _unit(x + 0.3 / np.sqrt(dim) * rng.normal(size=x.shape)), _unit(x[:100] + 0.35 * (centres[rng.integers(0, 12, 100)]))])
        home, asked = vectors.asked_cells(x, centres, 0.93)
        a, b = np.nonzero(x @ x.T >= 0.93)
        assert len(a) > len(x) and asked[a, home[b]].all()


def test_links_of_a_dense_group_beyond_a_shard(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([_near(rng, _unit(rng.normal(size=64)), 600, 0.96), _unit(rng.normal(size=(1000, 64)))])
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    true = (x @ x.T >= 0.93).sum(1) - 1
    got = {r.vec_id: r.n_links for r in vectors.deduplicated(df, shard=64).collect()}
    assert all(got[i] <= n for i, n in enumerate(true))
    assert sum(got.values()) >= 0.99 * true.sum() > 300_000


def _graph_of(x):
    import pyarrow as pa

    made = vectors._graph((), pa.table({"node": np.arange(len(x)), "v": pa.array(x.tolist(), pa.list_(pa.float64()))}))
    ahead = np.full((len(x), 2 * vectors.DEGREE + 1), -1)
    for row, js in zip(ahead, made.column("next").to_pylist()):
        row[: len(js)] = js
    return ahead


@pytest.mark.parametrize("sizes", [[120, 120], [150] * 10, [2] * 60 + [130, 500, 97]])
def test_search_finds_groups_that_no_edge_joins(sizes):
    rng = np.random.default_rng(7)
    x = np.concatenate([_near(rng, _unit(rng.normal(size=64)), n, 0.97) for n in sizes])
    x = x[rng.permutation(len(x))]
    ahead = _graph_of(x)
    for more in ({}, {"own": np.arange(len(x))}):
        got = sum(len(hit) for hit, _ in vectors.search(x, ahead, x, 0.93, **more))
        assert got == (x @ x.T >= 0.93).sum()


def test_links_of_groups_in_small_shards(spark):
    rng = np.random.default_rng(8)
    groups = [_near(rng, _unit(rng.normal(size=32)), n, 0.95) for n in (2, 3, 5, 20, 97, 150, 500)]
    x = np.concatenate([*groups, _unit(rng.normal(size=(400, 32)))])
    label = np.arange(len(x)) % 2
    df = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label))], "vec_id long, embedding array<double>, label int")
    true = ((x @ x.T >= 0.93) & (label[:, None] == label)).sum(1) - 1
    got = {r.vec_id: r.n_links for r in vectors.deduplicated(df, shard=128).collect()}
    assert all(got[i] <= n for i, n in enumerate(true))
    assert sum(got.values()) >= 0.99 * true.sum() > 100_000
    assert vectors.audit(df, shard=128) >= 0.99


def test_mixing_odd_rows(odd_documents):
    got = mixing.mixed(odd_documents, weights={"a": 1.0, "b": 2.0, None: 1.0}, epochs=40.0)
    per = Counter((r.source, r.doc_id) for r in got.collect())
    assert per[("b", 4)] % 2 == 0 and got.columns == [*odd_documents.columns, "copy", "shuffle_key"]
    assert mixing.mixed(odd_documents.limit(0)).count() == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c.isdigit()]
            luhn = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))) % 10 == 0
            if kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")) or kind == "card" and 13 <= len(digits) <= 19 and luhn or kind == "phone" and 9 <= len(digits) <= 15:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_pii_base_spans(spark, docs):
    import hashlib

    random.seed(3)
    parts = ["a", "@", ".", "..", "b-c", "_", "1", "22", "255", "256", "+1", " ", "-", "--", "(", ")", "é", "4111 1111 1111 1111", "4111111111111111", "x@y.z", "+49 30 1234567", "1.2.3.4", "\n"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 14))) for _ in range(2000)] + [None, "", "1 " * 30000, "a." * 30000 + "@" + "b." * 20000, "9" * 50000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(docs.select(F_plus("doc_id"), "text"))
    known = {r.doc_id: r.text or "" for r in df.collect()}
    for r in pii.digests(pii.found(df)).collect():
        base = _base(known[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r.spans.split(",")) | {""}
    assert pii.digests(pii.found(df.limit(0))).count() == 0


def F_plus(name):
    from pyspark.sql import functions as F

    return (F.col(name) + 100_000).alias(name)


def test_pii_redaction(spark):
    df = spark.createDataFrame([(1, "mail a@b.co or 1.2.3.4 now"), (2, None), (3, "é a@b.co")], "doc_id long, text string")
    assert [r.text for r in pii.redacted(df).orderBy("doc_id").collect()] == ["mail <email> or <ip> now", None, "é <email>"]


def test_quality_on_held_out_labels(spark, odd_documents):
    where = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{where}/documents.parquet"), spark.read.parquet(f"{where}/labels.parquet")
    got = {r.doc_id: r for r in quality.scored(docs, labels).collect()}
    held = [(got[r.doc_id].predicted, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert np.mean([p == q for p, q in held]) > 0.93
    assert quality.scored(odd_documents, labels.limit(0)).count() == odd_documents.count()


def _components(rows):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    low = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    sets = []
    for _, text in rows:
        w = word.findall((text or "").translate(low))
        sets.append({tuple(w)} if 0 < len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)})
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                parent[find(i)] = find(j)
    lowest = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            lowest[find(i)] = min(doc_id, lowest.get(find(i), doc_id))
    return Counter((rows[i][0], len(sets[i]), lowest.get(find(i))) for i in range(len(rows)))


def test_jaccard_equals_brute_force(spark, docs, odd_documents):
    random.seed(4)
    base = [f"w{k}" for k in range(70)]
    near = [(1000 + i, " ".join(w if random.random() > 0.02 else "zz" for w in base[: random.choice([6, 20, 50, 70])])) for i in range(60)]
    for df in (docs.select("doc_id", "text"), odd_documents.select("doc_id", "text"), spark.createDataFrame(near, "doc_id long, text string")):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        assert Counter(tuple(r) for r in jaccard.joined(df).collect()) == _components(rows)
    assert jaccard.joined(docs.limit(0)).count() == 0


def test_rules_equal_brute_force(spark, docs, odd_documents):
    for df in (docs, odd_documents):
        known = Counter()
        for r in df.collect():
            text = r.text or ""
            w = re.findall(r"[^\x20\x09-\x0D]+", text)
            windows = Counter(zip(w, w[1:], w[2:]))
            again = {k + d for k in range(len(w) - 2) if windows[(w[k], w[k + 1], w[k + 2])] > 1 for d in range(3)}
            lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
            known[(r.doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again))] += 1
        got = rules.scored(df).collect()
        assert known == Counter((r.doc_id, *[r.counts[c] for c in rules.COUNTS[:5]]) for r in got)
        assert not any(r.kept for r in got if r.base_failed)
    assert rules.scored(docs.limit(0)).count() == 0


def test_rules_follow_the_labels(spark):
    where = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in rules.scored(spark.read.parquet(f"{where}/documents.parquet")).collect()}
    labels = [r for r in spark.read.parquet(f"{where}/labels.parquet").collect() if not got[r.doc_id].base_failed]
    assert np.mean([got[r.doc_id].kept == bool(r.quality) for r in labels]) > 0.98
