"""The fixed patterns against plain regular expressions, the network against findings it has not seen."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from cases import TEXTS, documents
from pyspark.sql import functions as F

from tidemark.llm import queries, secrets
from tidemark.llm.arrow_text import chunks

PATTERNS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    "access": (re.compile("AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile("[0-9a-f]+"), 0, 32),
}


def base_spans(text):
    found = []
    for order, (kind, (pattern, group, least)) in enumerate(PATTERNS.items()):
        for m in pattern.finditer(text or ""):
            if len(m[group]) >= least:
                found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(found)]


def awkward(seed):
    rng = random.Random(seed)
    parts = ["password", "PassWd", "token", "secret", "api_key", "ApiKey", "=", ": ", " ", '"', "'", "AKIA", "AKIA" + "Q7" * 8]
    parts += ["0123456789abcdef" * 2, "f" * 31, "é", "日本", "\n", "abcdefgh", "a.b=c/d+", "x" * 12, "passpassword=12345678", "tokentoken", "ſecret=12345678"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(1500)]


@pytest.fixture(scope="module")
def net(spark):
    rng = random.Random(2)
    texts = [f"some words token = \"{rng.randbytes(20).hex()}\" and more, see item{i}number." for i in range(80)]
    return secrets.fit(documents(spark, texts))


def test_base_spans_equal_plain_patterns():
    texts = [*awkward(1), *(t or "" for t in TEXTS), "password=" + "a" * 50_000, "0" * 70_000]
    for first, last, raw, offsets in chunks(pa.array(texts)):
        chunk = secrets.Chunk(raw, offsets)
        found = {i: [] for i in range(last - first)}
        for order, (kind, spans) in enumerate(zip(PATTERNS, chunk.base(), strict=True)):
            rows = np.searchsorted(chunk.row_starts, spans[:, 0], side="right") - 1
            begin, end = chunk.points(spans[:, 0]), chunk.points(spans[:, 1] - 1) + 1
            for row, a, b in zip(rows.tolist(), begin.tolist(), end.tolist(), strict=True):
                found[row].append((a, order, f"{kind}:{a}:{b}"))
        assert [[s for _, _, s in sorted(found[i])] for i in found] == [base_spans(t) for t in texts[first:last]]


def test_candidates_and_windows():
    text = "é before=Key0123456789zz, after it"
    (_, _, raw, offsets), = chunks(pa.array(["x1", text, "plainwordsonly 123456789012"]))
    chunk = secrets.Chunk(raw, offsets)
    spans = chunk.candidates()
    assert [chunk.bytes[a:b] for a, b in spans.tolist()] == [b"before=Key0123456789zz"]
    (window,) = chunk.windows(spans)
    inside = bytes((window[window >= 256] - 256).astype(np.uint8))
    assert inside == b"before=Key0123456789zz"
    assert bytes(window[(window > 0) & (window < 256)].astype(np.uint8)) == "é ".encode() + b", after "
    long = "a1" * 200
    (coded,) = secrets.coded([("k=", long, "")])
    assert bytes((coded[coded >= 256] - 256).astype(np.uint8)) == (long[:32] + long[-12:]).encode()


def test_overlap():
    spans, other = np.array([[0, 5], [5, 9], [20, 30], [40, 50]]), np.array([[4, 6], [22, 23], [50, 60]])
    assert secrets.overlapping(spans, [other]).tolist() == [True, True, True, False]
    assert not secrets.overlapping(spans, [other[:0]]).any()


def test_gradients_follow_the_loss():
    rng = np.random.default_rng(1)
    codes, labels = rng.integers(0, 512, (40, secrets.WINDOW)).astype(np.uint16), np.arange(40) % 2.0
    before = secrets.train(codes, labels, secrets.Settings(epochs=0))
    after = secrets.train(codes, labels, secrets.Settings(epochs=30))

    def loss(net):
        z = secrets.logits(net, codes)
        return float(np.logaddexp(0, np.where(labels > 0, -z, z)).mean())

    assert loss(after) < 0.2 * loss(before)


def test_calibration_and_thresholds():
    rng = np.random.default_rng(3)
    labels = (rng.random(6000) < 0.3).astype(float)
    z = 4 * rng.normal(size=6000) + np.where(labels > 0, 6, -2)
    slope, offset = secrets.calibrate(z, labels)
    p = 1 / (1 + np.exp(-(slope * z + offset)))
    for low in (0.1, 0.3, 0.5, 0.7):
        part = (p >= low) & (p < low + 0.2)
        assert abs(labels[part].mean() - p[part].mean()) < 0.1
    shape = rng.integers(0, 2, 6000)
    limits = secrets.constrained(p, labels, shape, secrets.Settings(recall=0.9))
    for k in (0, 1):
        mine = p[(labels > 0) & (shape == k)]
        assert (mine >= limits[k]).mean() >= 0.9 and (limits[k] == 0.5 or (mine > limits[k]).mean() < 0.9)
    assert limits[2] == secrets.constrained(p, labels, shape * 0 + 2, secrets.Settings(recall=0.9))[2]


def test_unseen_secrets_are_found_and_other_strings_left(net):
    findings, labels = secrets.made(2000, np.random.default_rng(77))
    codes = secrets.coded(findings)
    z = secrets.logits(net, codes)
    score = 1 / (1 + np.exp(-(net.scale * z + net.offset)))
    hit = score >= np.array([net.thresholds[k] for k in range(3)])[secrets.shapes(codes)]
    assert hit[labels == 1].mean() > 0.95 and hit[labels == 0].mean() < 0.03


def test_rows_and_digests(spark, net, monkeypatch):
    texts = [*awkward(2)[:80], *(t for t in TEXTS)]
    monkeypatch.setattr(secrets, "fit", lambda docs: net)
    monkeypatch.setattr(queries, "table", lambda s, d, n: documents(spark, texts))
    found = queries.op13_secrets(spark, "").where("doc_id is not null").dropDuplicates().collect()
    assert len(found) == len(texts)
    for r in found:
        base = base_spans(texts[r.doc_id - 1])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k) for s in base) for k in PATTERNS)
        spans = [s for s in r.spans.split(",") if s]
        assert [s for s in spans if not s.startswith("learned")] == base
        starts = [int(s.split(":")[1]) for s in spans]
        assert starts == sorted(starts) and r.n_learned == len(spans) - len(base)
    assert secrets.scan(documents(spark, []), net).count() == 0


def test_learned_spans_are_added(spark, net):
    key = "Zx81kQpo29LmNv47sTaYw0Bd"
    text = f"é use Authorization: Bearer {key} in the call, as in chapter-12.html of a book"
    (row,) = secrets.scan(documents(spark, [text]).where("doc_id = 1").limit(1), net, ("doc_id", "score")).collect()
    assert [(s.kind, text[s.start : s.end]) for s in row.spans] == [("learned", key)]


def test_nothing_to_learn_from_leaves_made_findings(spark):
    model = secrets.fit(documents(spark, []), secrets.Settings(epochs=1, made=200))
    assert secrets.scan(documents(spark, ["x", None]), model).select(F.size("spans").alias("n")).distinct().collect()[0].n == 0


def test_all_candidates_are_learned_from_in_shards(spark):
    rng = random.Random(5)
    few = secrets.Settings(made=2000)
    lines = [(f'see token = "{rng.randbytes(16).hex()}" here', f"see page {rng.randbytes(3).hex()}x{i}.html here") for i in range(2500)]
    docs = documents(spark, [text for pair in lines for text in pair])
    windows = secrets.findings(docs)
    n = windows.count()
    assert n >= 4900
    model = secrets.fit(docs, few)
    assert model.learned + model.held == n and model.learned > 0.6 * n
    made, labels = secrets.made(1000, np.random.default_rng(78))
    codes = secrets.coded(made)
    score = 1 / (1 + np.exp(-(model.scale * secrets.logits(model, codes) + model.offset)))
    hit = score >= np.array([model.thresholds[k] for k in range(3)])[secrets.shapes(codes)]
    assert hit[labels == 1].mean() > 0.9 and hit[labels == 0].mean() < 0.1


def test_counted_outputs_calibrate_like_repeated_ones():
    rng = np.random.default_rng(4)
    labels = (rng.random(500) < 0.4).astype(float)
    z, counts = rng.normal(size=500) + 2 * labels, rng.integers(1, 5, 500)
    shape = rng.integers(0, 3, 500)
    often = [np.repeat(a, counts) for a in (z, labels, shape)]
    assert np.allclose(secrets.calibrate(z, labels, counts), secrets.calibrate(*often[:2]), atol=1e-6)
    how = secrets.Settings(recall=0.9)
    score = [1 / (1 + np.exp(-x)) for x in (z, often[0])]
    assert secrets.constrained(score[0], labels, shape, how, counts) == secrets.constrained(score[1], *often[1:], how)
