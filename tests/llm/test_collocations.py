"""Collocation mining against counting everything."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from cases import TEXTS, documents
from pyspark.sql import functions as F

from tidemark.llm import collocations
from tidemark.llm.arrow_text import Hasher, Words, chunks, shingle_sets
from tidemark.llm.collocations import Mining


def phrases(rows, longest):
    """{(lang, phrase): count}, and words by language."""
    found, total = Counter(), Counter()
    for lang, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                found.update((lang or "und", " ".join(w[i : i + k])) for i in range(len(w) - k + 1))
    return found, total


def ranked(rows, least, top, longest=5):
    counts, total = phrases(rows, longest)
    counts = {k: n for k, n in counts.items() if n >= least}
    kept = defaultdict(list)
    for (lang, phrase), a in counts.items():
        w = phrase.split(" ")
        if len(w) < 2:
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = counts[lang, " ".join(w[:k])], counts[lang, " ".join(w[k:])]
            cuts.append((1000 * a * total[lang] // (left * right), k, left, right))
        held = any(l2 == lang and len(p.split(" ")) > len(w) and f" {phrase} " in f" {p} " and n >= a for (l2, p), n in counts.items())
        if not held:
            score, _, left, right = min(cuts)
            kept[lang].append((-score, -a, phrase.encode(), left, right))
    return {
        (lang, i, p.decode(), -a, left, right, total[lang], -score)
        for lang, rows in kept.items()
        for i, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1)
    }


def result(df):
    return {tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}


def corpus(seed):
    rng = random.Random(seed)
    fixed = ["new york city hall", "à la carte", "one two three four five six"]
    texts = []
    for _ in range(120):
        words = []
        for _ in range(rng.randint(0, 40)):
            words += rng.choice(fixed).split() if rng.random() < 0.3 else [rng.choice("a b c d New york é 日本".split())]
        texts.append("".join(w + rng.choice([" ", " ", "  ", "\t", ", ", ".\n"]) for w in words))
    return texts


@pytest.mark.parametrize("how", [Mining(least=12), Mining(least=12, share=0.03, ease=2.0), Mining(least=9, share=1.0, ease=1.0)])
def test_mining_equals_counting_everything(spark, how):
    """Whether the sample proposes too little (then further passes close the border) or too much."""
    texts = corpus(5)
    docs = documents(spark, texts)
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert result(collocations.collocations(docs, how, top=40)) == ranked(rows, how.least, 40)


def test_awkward_rows(spark):
    how = Mining(least=2)
    docs = documents(spark, [t for t in TEXTS if t is None or len(t) < 10_000])
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert result(collocations.collocations(docs, how)) == ranked(rows, 2, 2000)
    assert collocations.collocations(documents(spark, []), how).count() == 0
    assert collocations.collocations(documents(spark, [None, "", " . "])).count() == 0


def test_a_hot_phrase_in_one_text(spark):
    """All occurrences in one very long text that the sample may miss."""
    docs = documents(spark, ["x " * 20_000, "a b. " * 300, "a\tb"])
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert result(collocations.collocations(docs)) == ranked(rows, 100, 2000)


def test_scores_are_exact_beyond_64_bits(spark):
    a, n, left, right = 9 * 10**15, 10**16, 10**16 - 1, 10**16 - 3
    frame = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    over = F.lit(1000).cast("decimal(4,0)") * (collocations._exact("a") * collocations._exact("n"))
    score = frame.select(over.alias("over"), (collocations._exact("l") * collocations._exact("r")).alias("under"))
    assert score.select(F.expr("over div under").alias("s")).first().s == 1000 * a * n // (left * right)


def thue_morse(size):
    letters = [bin(i).count("1") % 2 for i in range(size)]
    return "".join("ab"[x] for x in letters), "".join("ba"[x] for x in letters)


@pytest.mark.parametrize("size", [1024, 4096])
def test_words_that_agree_modulo_powers_of_two_hash_apart(size):
    one, other = thue_morse(size)
    (_, _, raw, offsets), = chunks(pa.array([one, other]))
    words = Words(raw, offsets)
    assert len(set(words.hashes.tolist())) == 2
    assert shingle_sets(raw, offsets, 3)[0].tolist() != shingle_sets(raw, offsets, 3)[1].tolist()


def test_hashes_do_not_depend_on_the_place():
    data = np.random.default_rng(1).integers(0, 256, 20_000).astype(np.uint8)
    starts, ends = np.array([0, 17, 5000, 9990, 4090, 19_992]), np.array([0, 60, 5100, 19_000, 4098, 20_000])
    long, apart = Hasher(data)(starts, ends), [Hasher(data[a:b])(np.array([0]), np.array([b - a]))[0] for a, b in zip(starts, ends)]
    assert long.tolist() == apart
    with_zeros = np.zeros(30, np.uint8)
    sizes = np.arange(31)
    assert len(set(Hasher(with_zeros)(np.zeros(31, np.int64), sizes).tolist())) == 31


def test_equal_hashes_do_not_make_equal_words(spark, monkeypatch):
    grams = collocations.Grams(*next(chunks(pa.array(["aa bb aa cc bb"])))[2:])
    assert grams.same(np.array([0, 1]), np.array([2, 4])) and not grams.same(np.array([0, 1]), np.array([2, 3]))
    texts = ["a" * n + " " + "a" * (n - 1) + "b " + "a" * n for n in (20, 90)]
    long = collocations.Grams(*next(chunks(pa.array(texts)))[2:])
    assert long.same(np.array([0]), np.array([2])) and not long.same(np.array([0]), np.array([1]))
    assert long.same(np.array([3]), np.array([5])) and not long.same(np.array([3]), np.array([4]))
    assert len(set(long.hashes.tolist())) == 4

    class Sent:
        value = collocations.Round(np.full(8, 255, np.uint8))

    monkeypatch.setattr(collocations, "mix", lambda h: np.zeros(len(h), np.uint64))
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "de"], "text": ["aa bb aa", "aa"]})
    found = Counter()
    for part in collocations._counts([batch], Sent, 2):
        for key, n in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            found[key] += n
    assert found[b"\1en\naa"] == 2 and found[b"\1de\naa"] == 1 and found[b"\1en\naa bb"] == 1 and found[b"\2en"] == 3


def test_a_round_sends_no_row_for_a_key(spark, monkeypatch):
    """The sample takes one round, all texts two; none of them adds up rows of single keys."""
    rounds, write = [], collocations.materialise

    def kept(df, label):
        if label == "counted":
            rounds.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, label)

    monkeypatch.setattr(collocations, "materialise", kept)
    docs = documents(spark, corpus(7))
    rows = [(r.lang, r.text) for r in docs.collect()]
    how = Mining(least=12, share=0.5)
    assert result(collocations.collocations(docs, how, top=40)) == ranked(rows, 12, 40)
    assert len(rounds) <= 3 and not any("Aggregate" in plan for plan in rounds)


@pytest.mark.parametrize("power", [6, 9])
@pytest.mark.parametrize("held", [1, 1 << 14, 1 << 25])
def test_parcels_add_up(monkeypatch, power, held):
    """However often a task packs, and also counts that do not go into a byte."""
    monkeypatch.setattr(collocations, "_HELD_BYTES", held)
    rows = [("en" if i % 3 else None, text) for i, text in enumerate([*corpus(9), "x y " * 700, "z " * 255, "", None])]
    batches = [
        pa.RecordBatch.from_pydict({"lang": pa.array([lang or "und" for lang, _ in part]), "text": pa.array([text for _, text in part], pa.string())})
        for part in (rows[:50], rows[50:90], rows[90:])
    ]
    counts, total = phrases(rows, 3)

    def merged(turn, least):
        class Sent:
            value = turn

        sent = [p for batch in batches for p in collocations._parcels(collocations._counts([batch], Sent, 3), power)]
        assert all(p.num_rows <= 1 << power for p in sent)
        parts = {}
        for parcel in sent:
            for i, part in enumerate(parcel.column("part").to_pylist()):
                parts.setdefault(part, []).append(parcel.slice(i, 1))
        return [row for one in parts.values() for batch in collocations._merged(one, least, power) for row in batch.to_pylist()]

    languages = {b"\2" + lang.encode(): n for lang, n in total.items()}
    for least in (1, 300):
        enough = {b"\1" + lang.encode() + b"\n" + phrase.encode(): n for (lang, phrase), n in counts.items() if n >= least}
        found = merged(collocations.Round(np.full(8, 255, np.uint8)), least)
        assert {r["key"]: r["n"] for r in found} == enough | languages and len(found) == len(enough) + len(languages)
        found = merged(collocations.Round(), least)
        assert sorted(r["n"] for r in found if r["key"] is None) == sorted(enough.values())
        assert {r["key"]: r["n"] for r in found if r["key"]} == languages
        assert all((r["kind"], r["q"] is None) == ((0, False) if r["key"] is None else (2, True)) for r in found)
