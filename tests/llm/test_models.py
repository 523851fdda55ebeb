"""Learned operators: held-out accuracy, and what they do with awkward rows."""

import numpy as np
import pytest
from cases import TEXTS, documents
from pyspark.sql import functions as F

from tidemark.llm import language, quality, queries, toxicity


def truth(spark, folder, table, column):
    rows = spark.read.parquet(f"{folder}/{table}.parquet").select("doc_id", column).collect()
    return {r[0]: r[1] for r in rows}


def test_language_of_held_out_texts(spark, sf_larger):
    lang = truth(spark, sf_larger, "documents", "lang")
    found = queries.op2_language_id(spark, sf_larger).collect()
    held = [r for r in found if r.held_out]
    assert len(found) == len(lang) and 0.2 < len(held) / len(found) < 0.5
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_language_of_awkward_rows(spark):
    docs = documents(spark)
    model = language.fit(docs, F.lit(True), language.Settings(epochs=1))
    found = language.predict(docs, model, ["doc_id", "node"]).collect()
    assert len(found) == len(TEXTS) + 2
    by_id = {r.doc_id: r for r in found}
    assert [by_id[i].lang_pred for i in (1, 2, 3, 4)] == ["und"] * 4 and by_id[5].lang_pred == "en"
    assert language.fit(docs.where("lang is null"), F.lit(True)) is None
    assert {r.lang_pred for r in language.predict(docs, None).collect()} == {"und"}
    assert language.predict(documents(spark, []), model).count() == 0


def test_the_sample_is_bounded_by_language_and_copies_count_once(spark, monkeypatch):
    taken = {}
    monkeypatch.setattr(language, "train", lambda rows, labels, languages, how: taken.update(rows=rows, labels=labels, languages=languages))
    texts = [("zz", f"zz text number {i} of many") for i in range(300)] + [("aa", "the same text again")] * 5000
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string")
    language.fit(docs, F.lit(True), language.Settings(windows_per_language=100, window=64))
    counts = dict(zip(*np.unique(np.array(taken["languages"])[taken["labels"]], return_counts=True), strict=True))
    assert counts.get("aa", 0) <= 1 and 60 < counts["zz"] <= 200


def test_table_form_equals_the_network():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 256, (40, 64)).astype(np.uint8)
    how = language.Settings(window=64, epochs=1, widths=(2, 3, 4, 5))
    model = language.train(rows, rng.integers(0, 3, 40), ["a", "b", "c"], how)
    features, _, _ = language._forward(model, rows)
    logits = features @ model.out + model.out_bias
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    assert np.allclose(language.Predictor(model).probabilities(rows), p / p.sum(axis=1, keepdims=True), atol=1e-4)


def test_toxicity_of_held_out_texts(spark, sf_larger):
    toxic = truth(spark, sf_larger, "labels", "toxic")
    found = queries.op6_toxicity(spark, sf_larger).collect()
    held = [r for r in found if r.held_out and r.doc_id in toxic]
    assert np.mean([r.predicted == toxic[r.doc_id] for r in held]) > 0.9
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in found)


def test_toxicity_of_awkward_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(8, 1, 0), (9, 1, 1), (13, 0, 1), (None, 1, 1), (14, None, 1)], "doc_id long, toxic int, quality int")
    model = toxicity.fit(docs, labels, F.lit(True))
    assert toxicity.score(docs, model).count() == len(TEXTS) + 2
    nothing = toxicity.fit(docs, labels.where("toxic = 0"), F.lit(True))
    assert {r.score < 1e-6 for r in toxicity.score(docs, nothing).collect()} == {True}
    assert toxicity.score(documents(spark, []), model).count() == 0


def test_risk_is_corrected_for_hidden_positives():
    rng = np.random.default_rng(2)
    prior, n = 0.2, 4000
    hidden = rng.random(n) < prior
    x_u = (rng.random((n, 2)) < np.where(hidden[:, None], [0.9, 0.5], [0.05, 0.5])).astype(float)
    x_p = (rng.random((800, 2)) < [0.9, 0.5]).astype(float)
    w, b = toxicity.nn_pu(x_p, x_u, prior, toxicity.Settings())
    chance = 1 / (1 + np.exp(-(np.array([[0, 0], [1, 0]]) @ w + b)))
    # By Bayes: 0.2 * 0.9 / (0.2 * 0.9 + 0.8 * 0.05) = 0.82 and 0.03.
    assert chance[0] < 0.1 and abs(chance[1] - 0.82) < 0.1


def test_quality_agrees_with_labels_it_never_sees(spark, sf_larger):
    good = truth(spark, sf_larger, "labels", "quality")
    found = [r for r in queries.op8_quality(spark, sf_larger).collect() if r.doc_id in good]
    assert np.mean([r.predicted == good[r.doc_id] for r in found]) > 0.95
    assert np.mean([r.predicted for r in found if good[r.doc_id]]) > 0.97


def test_copies_count_once_in_the_sample_of_quality(spark, monkeypatch):
    taken, fit = [], quality._fit_scorer
    monkeypatch.setattr(quality, "_fit_scorer", lambda found, good, how: taken.append(len(found)) or fit(found, good, how))
    texts = ["the same text again and again"] * 500 + [f"text number {i} of a few" for i in range(30)]
    found = quality.classify(documents(spark, texts), how=quality.Settings(sample=10_000)).collect()
    assert len(found) == len(texts) + 2 and taken == [32]  # documents() adds one text
    assert len({r.score for r in found if r.doc_id is not None and r.doc_id <= 500}) == 1
    taken.clear()
    quality.classify(documents(spark, texts), how=quality.Settings(sample=5)).collect()
    assert all(n <= 10 for n in taken)


def test_quality_of_awkward_rows(spark):
    found = quality.classify(documents(spark)).collect()
    assert len(found) == len(TEXTS) + 2 and all(0 <= r.score <= 1 and 0 <= r.posterior <= 1 for r in found)
    assert quality.classify(documents(spark, [])).count() == 0


def test_em_recovers_accuracies():
    rng = np.random.default_rng(4)
    good = rng.random(20_000) < 0.8
    says = rng.random((quality.LABELLERS, len(good)))
    bad_rate = np.where(good, 0.02, 0.35)
    given = np.where(says < bad_rate, quality.BAD, quality.GOOD)
    given[rng.random(given.shape) < 0.3] = quality.NONE
    seen, count = np.unique(quality.patterns(given), return_counts=True)
    chance, posterior = quality.accuracies(seen, count.astype(float))
    assert np.abs(chance[:, quality.BAD, 1] - 0.35).max() < 0.05
    assert np.abs(chance[:, quality.BAD, 0] - 0.02).max() < 0.01
    means = dict(zip(seen.tolist(), posterior.tolist(), strict=True))
    assert np.mean([(means[p] > 0.5) == g for p, g in zip(quality.patterns(given).tolist(), good, strict=True)]) > 0.85


@pytest.mark.parametrize("seed", [1, 2])
def test_patterns_keep_the_votes(seed):
    given = np.random.default_rng(seed).integers(0, 3, (quality.LABELLERS, 50))
    assert (quality.unpacked(quality.patterns(given)) == given).all()
