"""Links, components and archives against brute force."""

import base64
import hashlib
import random

import numpy as np
import pytest
from cases import BASE, TEXTS, documents, jaccard_groups, smallest_reachable
from pyspark.sql import functions as F

from tidemark.llm import embedding, jaccard, warc
from tidemark.llm.components import connected
from tidemark.llm.lattice import decode, shortest_vectors


@pytest.mark.parametrize("shape", ["random", "chain", "star", "none"])
def test_components(spark, shape):
    rng = random.Random(2)
    edges = {
        "random": [(rng.randint(0, 200), rng.randint(0, 200)) for _ in range(120)],
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(7, i) for i in range(60)],
        "none": [],
    }[shape]
    frame = spark.createDataFrame([*edges, (None, 3), (5, 5)], "a long, b long")
    found = {r.node: r.component for r in connected(frame).collect()}
    real = [(a, b) for a, b in edges if a != b]
    assert found == smallest_reachable({n for e in real for n in e}, real)


def near_copies(seed=4):
    """Copies of a few texts with growing edits, some at the threshold."""
    rng = random.Random(seed)
    texts = list(TEXTS)
    for base in (BASE, " ".join(f"w{rng.randint(0, 50)}" for _ in range(150)), "a b c d e f g h i j k l"):
        for _ in range(60):
            words = base.split()
            for _ in range(rng.randint(0, 6)):
                words[rng.randrange(len(words))] = f"new{rng.randint(0, 30)}"
            texts.append(" ".join(words))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("how", [jaccard.Similarity(3, 90, 100), jaccard.Similarity(5, 80, 100)])
def test_jaccard_matches_all_pairs(spark, how, monkeypatch):
    monkeypatch.setattr(jaccard, "_HUB_OVER", 3)
    texts = near_copies()
    found = jaccard.jaccard_components(documents(spark, texts), how).collect()
    want = jaccard_groups(list(enumerate(texts, 1)), how.words, how.num, how.den)
    assert len(found) == len(texts) + 2
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found if r.doc_id is not None} == want
    assert [r.component_id for r in found if r.doc_id is None] == [None]


def test_jaccard_of_nothing(spark):
    assert jaccard.jaccard_components(documents(spark, [])).count() == 0
    empty = jaccard.jaccard_components(documents(spark, [None, "", " "])).where("doc_id is not null").collect()
    assert all(r.n_shingles == 0 and r.component_id == r.doc_id for r in empty)


def test_prefixes_share_what_they_ask_for():
    rng = np.random.default_rng(0)
    how = jaccard.Similarity(3, 90, 100)
    sketch = rng.integers(0, 50, 1 << 20)
    for _ in range(200):
        whole = np.unique(rng.integers(1, 2**63, 120, dtype=np.uint64))
        x, y = whole[rng.random(len(whole)) > 0.04], whole[rng.random(len(whole)) > 0.04]
        shared = len(np.intersect1d(x, y))
        if shared * 100 < 90 * (len(x) + len(y) - shared):
            continue
        (m, p), (n, q) = (jaccard.prefix(s, sketch, 20.0, how) for s in (x, y))
        assert len(np.intersect1d(p, q)) >= min(m, n)


def vectors():
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(150):
        b = rng.normal(size=64)
        b /= np.linalg.norm(b)
        for c in (1, 0.9001, 0.92, 0.95, 0.99):
            z = rng.normal(size=64)
            z -= (z @ b) * b
            z /= np.linalg.norm(z)
            rows.append((3 * (c * b + np.sqrt(1 - c * c) * z)).tolist())
    rows += [rows[0]] * 300 + [(np.array(rows[5]) + 0.05 * rng.normal(size=64)).tolist() for _ in range(320)]
    return rows


# As planned for these rows, and as for millions of vectors.
@pytest.mark.parametrize("count", [None, 1 << 23])
def test_embeddings_match_brute_force(spark, count, monkeypatch):
    monkeypatch.setattr(embedding, "_CHUNK", 64)
    how = count and embedding.planned(count)
    rows = vectors()
    odd = [None, [], [0.0] * 64, [float("nan")] * 64, [None, *[1.0] * 63], [float("inf"), *[0.0] * 63], [1.0, 0.0], [2.0, 0.0]]
    data = [(i, v, 0) for i, v in enumerate([*rows, *odd])] + [(None, rows[0], 0)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>, node int")
    found = {r.vec_id: r for r in embedding.near(frame, how).collect()}
    assert len(found) == len(data)
    x = np.array(rows, dtype=np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.9
    np.fill_diagonal(linked, False)
    count = np.array([found[i].n_links for i in range(len(rows))])
    assert (count <= linked.sum(axis=1)).all()
    assert count.sum() >= 0.97 * linked.sum()
    low = smallest_reachable(range(len(rows)), zip(*np.nonzero(np.triu(linked)), strict=True))
    same = [found[i].component_id == low[i] for i in range(len(rows))]
    assert sum(same) >= 0.9 * len(same)
    for i in range(len(rows), len(rows) + 6):
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True)
    assert found[len(rows) + 6].n_links == found[len(rows) + 7].n_links == 1
    assert (found[None].n_links, found[None].component_id, found[None].kept) == (0, None, False)
    assert embedding.near(frame.limit(0)).count() == 0


@pytest.mark.parametrize("count", [1 << 13, 1 << 20, 1 << 30])
def test_planned_lattices_keep_their_recall(count):
    rng = np.random.default_rng(8)
    how = embedding.planned(count)
    x = embedding.unit(rng.normal(size=(1000, 64)))
    z = rng.normal(size=x.shape)
    z = embedding.unit(z - (z * x).sum(axis=1, keepdims=True) * x)
    (a, looked), (b, seen) = (embedding.cells(v, how) for v in (x, 0.9 * x + np.sqrt(1 - 0.81) * z))
    met = (a == b) | (looked == b[:, :, None]).any(axis=2) | (seen == a[:, :, None]).any(axis=2)
    assert met.any(axis=1).mean() >= 0.95
    one, probed = embedding.cells(x[:1], how)
    assert (one == a[:1]).all() and (probed == looked[:1]).all()


def test_comparisons_grow_far_slower_than_the_table():
    few, many = (embedding.expected(n, embedding.planned(n))[1] for n in (1 << 13, 1 << 30))
    assert many < 32 * few


def test_e8_decoding_is_nearest():
    steps = shortest_vectors()
    assert len(steps) == 240 and (steps**2).sum(axis=1).tolist() == [8] * 240
    y = np.random.default_rng(3).normal(size=(500, 8)) * 3
    point = decode(y)
    own = ((y - point / 2) ** 2).sum(axis=1)
    others = ((y[:, None] - (point[:, None] + steps) / 2) ** 2).sum(axis=2)
    assert (own[:, None] <= others + 1e-9).all()


PAGES = [
    (1, "http://www.example.com/a?b=1#x", "<p>one</p>", 5),
    (2, "https://user@Example.COM:8080/a", "<p>two\r\n\r\n</p>", 5),
    (3, "http://www.example.com/a?b=1", "<p>one</p>", 5),
    (4, None, None, 5),
    (5, "", "", 5),
    (6, "no url\r\nX-Header: y", "é🙂" * 5000, 5),
    (7, "http://www.example.com/a?b=1", "<p>one</p>", 5),
    (7, "http://www.example.com/a?b=1", "<p>one</p>", 5),
    (None, "http://z.org", "<p>one</p>", 5),
]


@pytest.mark.parametrize("least", [0, 11])
def test_archives_read_back(spark, tmp_path, least, monkeypatch):
    monkeypatch.setattr(warc, "_BLOCK_LINES", 2)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, key int")
    folder = str(tmp_path / "archives")
    archives = warc.write(pages, folder, least_bytes=least)
    keys = pages.select(warc.url_key(F.col("url")).alias("key"))
    rows = warc.lookup(archives, folder, keys, payload=True).collect()
    assert len(rows) == len(PAGES)
    data = {i: (h or "").encode() for i, _, h, _ in PAGES}
    for r in rows:
        payload = data[r.page_id]
        largest = max(i for i, p in data.items() if i is not None and p == payload)
        own = len(payload) < least or r.page_id == largest
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert r.payload_bytes == len(payload)
        assert (r.record_type, r.refers_to) == (("response", None) if own else ("revisit", largest))
        assert (None if r.payload is None else bytes(r.payload)) == (payload if own else None)
    one = warc.lookup(archives, folder, spark.createDataFrame([("com,example)/a",), ("x",), (None,)], "key string"))
    assert [r.page_id for r in one.collect()] == [2]
    none = warc.write(pages.limit(0), str(tmp_path / "none"))
    assert warc.lookup(none, str(tmp_path / "none"), keys).count() == 0


def test_stores_of_archives(spark):
    same = ["/data/x", "relative/a:b", "s3://b/x", "hdfs://h/x", "file:///tmp/x", "abfss://c@a.b/x"]
    assert [warc.store_uri(u) for u in same] == same
    assert [warc.store_uri(u) for u in ("s3a://b/x", "S3N://b/x")] == ["s3://b/x", "s3://b/x"]
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, key int")
    with pytest.raises(ValueError, match="dbfs"):
        warc.write(pages, "dbfs:/archives")


def test_url_keys(spark):
    urls = ["http://www.example.com/a?b=1#x", "https://u@Example.COM:8080/a", "http://a.b", "plain", "", None]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r.key for r in frame.select(warc.url_key(F.col("url")).alias("key")).collect()] == [
        "com,example,www)/a?b=1", "com,example)/a", "b,a)", "plain", "-", "-",
    ]
