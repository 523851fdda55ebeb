"""Encoding, packing, licences and fingerprints against plain versions."""

import base64
import hashlib
import random
import struct
import textwrap
import time
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from cases import TEXTS, bigrams, documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer as PublicTokenizer

from tidemark.llm import byte_bpe, licenses, merkle, packing
from tidemark.llm.arrow_text import chunks

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(texts):
    with open(RANKS, "rb") as file:
        bpe = byte_bpe.tokenizer(file.read())
    found = []
    for first, last, raw, offsets in chunks(pa.array(texts, pa.string())):
        ids, bounds = bpe.encode(raw, offsets)
        assert bpe.decode(ids).tobytes() == raw.tobytes()
        found += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return found


def test_ids_are_those_of_the_public_library(reference):
    rng = random.Random(3)
    letters = list("ab'stremvld  \n\t.1é日🙂　 \x1c")
    texts = TEXTS + ["".join(rng.choices(letters, k=rng.randint(0, 30))) for _ in range(5000)]
    assert encoded(texts) == [reference.encode_ordinary(t or "") for t in texts]


@pytest.mark.parametrize("size", [512, 1024, 4096])
def test_words_of_one_hash_keep_their_ids(reference, size):
    """Thue-Morse words agree in every polynomial hash modulo a power of two."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(size))
    other = one.translate({97: "b", 98: "a"})
    assert encoded([one, other, one]) == [reference.encode_ordinary(t) for t in (one, other, one)]


def test_colliding_hashes_are_found_out(reference, monkeypatch):
    monkeypatch.setattr(byte_bpe.Hasher, "__call__", lambda self, a, b: np.ones(len(a), np.uint64))
    byte_bpe.tokenizer.cache_clear()
    texts = ["one two three", "four", "one two"]
    assert encoded(texts) == [reference.encode_ordinary(t) for t in texts]
    byte_bpe.tokenizer.cache_clear()


def test_every_code_point_is_classed_as_the_library_does(reference):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b {c}1{c}{c}" for c in points[::7] + points[:0x3100]]
    assert encoded(texts) == [reference.encode_ordinary(t) for t in texts]


def test_the_other_public_tokenizer_gives_the_same_ids():
    path = public_tokenizers.path("byte_bpe_50k.json")
    public = PublicTokenizer.from_file(path)
    end = "<|endoftext|>"
    cut = [f"a{end} x", end, end + end, f" {end} ", f"x {end}{end}\n y{end}", "<|endoftext", "|>", f"é{end}'s"]
    rng = random.Random(4)
    cut += ["".join(rng.choices([end, "<|endoftext", "|>", " a", "  ", "é", "\n"], k=rng.randint(0, 6))) for _ in range(300)]
    texts = [*TEXTS, *cut]
    with open(RANKS, "rb") as file:
        bpe = byte_bpe.tokenizer(file.read())
    found = []
    for _, _, raw, offsets in chunks(pa.array(texts, pa.string())):
        ids, bounds = packing.encode_around(bpe, raw, offsets, packing.added_tokens(path))
        found += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert found == [public.encode(t or "", add_special_tokens=False).ids for t in texts]
    public.encode_special_tokens = True
    assert encoded(texts) == [public.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_encode_and_decode_rows(spark, reference):
    rows = byte_bpe.encode(documents(spark), RANKS, spans=True, decoded=True)
    found = rows.collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(TEXTS) + 2
    for i, text in enumerate(TEXTS, 1):
        ids = reference.encode_ordinary(text or "")
        data = (text or "").encode()
        assert by_id[i].n_tokens == len(ids)
        assert bytes(by_id[i].ids) == struct.pack(f"<{len(ids)}I", *ids)
        assert bytes(by_id[i].decoded) == data
        parts = reference.decode_tokens_bytes(ids)
        starts = np.cumsum([0, *map(len, parts)])[:-1] if parts else []
        assert np.frombuffer(by_id[i].starts, "<u4").tolist() == list(starts)
    texts = {r.doc_id: bytes(r.decoded) for r in byte_bpe.decode(rows, RANKS).collect()}
    assert all(texts[i] == (t or "").encode() for i, t in enumerate(TEXTS, 1))
    assert byte_bpe.encode(documents(spark, []), RANKS).count() == 0


def test_packing_places_every_piece(spark, reference):
    rows = packing.pack(documents(spark), RANKS, with_ids=True)
    found = rows.collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append(r)
    for i, text in enumerate(TEXTS, 1):
        ids = [*reference.encode_ordinary(text or ""), 2]
        at = 0
        copies = 2 if i == 8 else 1
        for r in sorted(pieces[i], key=lambda r: r.piece)[::copies]:
            part = ids[at : at + r.length]
            assert r.start == at and r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            assert r.length == 1024 or r.piece == 0
            at += r.length
        assert at == len(ids)
    for parts in bins.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    joined = {r.sequence_id: r for r in packing.sequences(rows).collect()}
    for number, parts in bins.items():
        whole = b"".join(bytes(r.ids) for r in sorted(parts, key=lambda r: r.offset))
        assert bytes(joined[number].ids) == whole and joined[number].length * 4 == len(whole)
    assert packing.pack(documents(spark, []), RANKS).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_the_plan_fills_bins_closely(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 1024): rng.randint(1, 9) for _ in range(300)}
    rows = packing.plan(counts, 1024)
    placed = defaultdict(int)
    fill = defaultdict(int)
    for length, begin, end, copies, first, offset in rows:
        assert begin == placed[length] and (end - begin) % copies == 0
        placed[length] = end
        for number in range(first, first + (end - begin) // copies):
            fill[number] += copies * length
    assert placed == counts and max(fill.values()) <= 1024
    # No two pieces of more than half a bin share one.
    halves = sum(n for k, n in counts.items() if k > 512)
    least = max(-(-sum(k * n for k, n in counts.items()) // 1024), halves)
    assert len(fill) <= least * 1.02 + 1


def test_fullest_is_the_best_fill():
    rng = random.Random(1)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 2) for _ in range(4)}
        items = [length for length, n in counts.items() for _ in range(n)]
        rest = list(items)
        rest.remove(max(items))
        sums = {0}
        for length in rest:
            sums |= {s + length for s in sums}
        best = max(items) + max(s for s in sums if s <= 40 - max(items))
        assert sum(k * n for k, n in packing.fullest(counts, 40).items()) == best


def test_licences_are_found(spark):
    found = licenses.scan(documents(spark)).collect()
    assert [(r.doc_id, r.license, r.dice, r.n_lines, r.first_line) for r in sorted(found, key=lambda r: r.license)] == [
        (17, "All-Rights-Reserved", 1.0, 1, 1),
        (17, "MIT", 1.0, 1, 0),
    ]
    assert licenses.scan(documents(spark, [])).count() == 0


def test_wrapped_notices_are_found(spark):
    apache = next(t for _, t in licenses.TEMPLATES if "obtain a copy of the License" in t)
    mit, bsd = (next(t for _, t in licenses.TEMPLATES if t.startswith(w)) for w in ("Permission", "Redistribution"))
    wrapped = [" #\n # ".join(textwrap.wrap(t, 30)) for t in (apache, mit, bsd)]
    texts = [
        "Some prose goes on before it. Released under the\nMIT License. And more prose that goes on after it.",
        *(f"# words before\n# {t}\n#\n# and words after that" for t in wrapped),
        "Nothing was released, and no license under the sun is for MIT.",
        "x\ny, released under the MIT License, z",
    ]
    found = sorted(licenses.scan(documents(spark, texts)).where("doc_id is not null").collect())
    assert [(r.doc_id, r.license, r.n_lines, r.first_line) for r in found] == [
        (1, "MIT", 0, None),
        (2, "Apache-2.0", 0, None),
        (3, "MIT", 0, None),
        (4, "BSD-3-Clause", 0, None),
        (6, "MIT", 1, 1),
    ]
    assert all(r.dice == 1.0 for r in found)


def best_windows(text, templates):
    """{license: best coefficient of any window of words}, by trying all."""
    found, words = {}, licenses._words(text)
    for name, notice in templates:
        notice = set(licenses.template_bigrams(notice))
        for begin in range(len(words)):
            for end in range(begin + 2, len(words) + 1):
                held = bigrams(words[begin:end])
                dice = 2 * len(held & notice) / (len(held) + len(notice))
                found[name] = max(dice, found.get(name, 0))
    return {name: dice for name, dice in found.items() if dice >= 0.8}


def test_windows_match_brute_force(spark):
    rng = random.Random(9)
    templates = [("A", "one two three four five"), ("B", "a b a c b a d e f"), ("C", "u v w x y z u v")]
    texts = []
    for _ in range(150):
        words = [rng.choice("a b c one two u v zz".split()) for _ in range(rng.randint(0, 6))]
        for _ in range(2):
            words += licenses._words(rng.choice(templates)[1])
            for _ in range(rng.randint(0, 3)):
                words.insert(rng.randrange(len(words)), rng.choice("a b one u zz".split()))
        texts.append("".join(w + rng.choice(" \n,") for w in words))
    found = {(r.doc_id, r.license): r.dice for r in licenses.scan(documents(spark, texts), templates).collect()}
    want = {(i, n): d for i, t in enumerate(texts, 1) for n, d in best_windows(t, templates).items()}
    assert {k: d for k, d in found.items() if k[0] is not None} == want and len(want) > 100


@pytest.mark.parametrize("repeats", [5, 60, 500, 20_000])
def test_repeated_words_inside_a_notice_do_not_hide_it(spark, repeats):
    notice = " ".join(f"w{i}" for i in range(41))
    text = "before it " + notice.replace("w20 ", "w20 " + "x y " * repeats) + " after it"
    found = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), [("A", notice)]).collect()
    pairs = bigrams(text.split()[2:-2])
    want = 2 * len(pairs & bigrams(notice.split())) / (len(pairs) + 40)
    assert [(r.license, r.dice) for r in found] == [("A", want)] and want > 0.9


def test_licences_of_equal_dice_all_count(spark):
    texts = spark.createDataFrame([(1, "x one two three four y"), (1, None), (None, "")], "doc_id long, text string")
    found = licenses.scan(texts, [("A", "one two three four"), ("B", "One, two; three four.")]).collect()
    assert sorted((r.license, r.dice, r.n_lines, r.first_line) for r in found) == [("A", 1.0, 1, 0), ("B", 1.0, 1, 0)]
    assert licenses.scan(texts, []).count() == 0


def test_a_text_of_licences_only_is_scanned_in_seconds(spark):
    pool = [t for _, t in licenses.TEMPLATES + licenses.STANDARD]
    rng, parts, size = random.Random(3), [], 0
    while size < 10_000:
        parts.append(rng.choice(pool))
        size += len(licenses._words(parts[-1]))
    texts = spark.createDataFrame([(1, "\n".join(parts))], "doc_id long, text string")
    licenses.scan(texts.limit(0)).collect()
    begun = time.monotonic()
    found = {r.license for r in licenses.scan(texts).collect()}
    assert time.monotonic() - begun < 60
    assert len(found) > 15


MIT_LINES = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
GPL_LINES = """This {0} is free software: you can redistribute it and/or modify
it under the terms of the GNU {1} as published by
the Free Software Foundation, either version {2} of the License, or
(at your option) any later version.

This {0} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {1} for more details.

You should have received a copy of the GNU {1}
along with this {0}.  If not, see <https://www.gnu.org/licenses/>."""


def test_standard_texts_are_found_and_told_apart(spark):
    general, lesser = "General Public License", "Lesser General Public License"
    texts = {
        MIT_LINES: "MIT",
        "This project is licensed under the MIT License.": "MIT",
        "Licensed under the GNU General Public License v2.0": "GPL-2.0",
        "it is licensed under the GNU General Public License, version 2": "GPL-2.0",
        "it is licensed under the GNU Lesser General Public License, version 2.1": "LGPL-2.1",
        "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "CC-BY-SA-4.0",
        "Licensed under a Creative Commons Attribution 3.0 Unported License": "CC-BY-3.0",
        GPL_LINES.format("program", general, "3"): "GPL-3.0",
        GPL_LINES.format("program", general, "2"): "GPL-2.0",
        GPL_LINES.format("library", lesser, "2.1"): "LGPL-2.1",
        "# " + GPL_LINES.format("program", "Affero " + general, "3").replace("\n", "\n# "): "AGPL-3.0",
    }
    found = licenses.scan(documents(spark, list(texts))).where("doc_id is not null").collect()
    assert sorted((r.doc_id, r.license) for r in found) == list(enumerate(texts.values(), 1))


@pytest.mark.parametrize("name", ["Apache-2.0", "GPL-2", "GPL-3", "LGPL-2.1", "LGPL-3", "MPL-2.0", "CC0-1.0", "BSD"])
def test_installed_licence_files_are_found(spark, name):
    file = Path("/usr/share/common-licenses", name)
    if not file.is_file():
        pytest.skip("licence file not present")
    found = licenses.scan(documents(spark, [file.read_text()])).where("doc_id is not null").collect()
    want = {"BSD": "BSD-3-Clause"}.get(name, name if "." in name else f"{name}.0")
    assert want in {r.license for r in found}


def test_anchor_words_are_necessary():
    rng = random.Random(5)
    for _, text in licenses.TEMPLATES:
        notice = licenses.template_bigrams(text)
        words = licenses.anchors(notice, 0.8)
        pool = licenses._words(text) + ["x", "y", "z"]
        for _ in range(300):
            piece = list(licenses._words(text))
            for _ in range(rng.randint(0, 4)):
                piece[rng.randrange(len(piece))] = rng.choice(pool)
            other = bigrams(piece)
            dice = 2 * len(other & set(notice)) / max(1, len(other) + len(notice))
            if dice >= 0.8:
                low, high = licenses.size_bounds(len(notice), 0.8)
                assert any(w in " ".join(piece) for w in words) and low <= len(other) <= high


def test_fingerprints_follow_edits(spark):
    found = {r.doc_id: r for r in merkle.edits(documents(spark)).collect() if r.doc_id is not None}
    texts = [t or "" for t in TEXTS]
    for i, text in enumerate(texts):
        follower = texts[(i + 1) % len(texts)]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + follower[:quarter]
        r = found[i + 1]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (r.near_edited == 1.0) == (edited == text)
        assert (r.near_next == 1.0) == (follower == text)
    same = {found[i].fingerprint for i, t in enumerate(texts, 1) if t == texts[7]}
    assert len(same) == 1 and len({r.fingerprint for r in found.values()}) == len(set(texts))
    assert found[8].near_edited > 0.5 > found[12].near_next
    assert merkle.edits(documents(spark, [])).count() == 0


def test_differing_sections_are_located(spark):
    frame = spark.createDataFrame([("a. b.\nc\nd", "a. b.\nC\nd\ne")], "x string, y string")
    changed = merkle.changed_sections(merkle.fingerprint(F.col("x")), merkle.fingerprint(F.col("y")))
    assert frame.select(changed.alias("at")).first().at == [1, 3]
