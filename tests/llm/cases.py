"""Awkward rows and brute-force versions shared by the tests."""

from __future__ import annotations

import re
from itertools import pairwise

LONG = " ".join(f"word{i % 977} and" for i in range(30_000))
BASE = " ".join(f"alpha{i} beta{i * 7 % 31} gamma{i}." for i in range(40))
TEXTS = [
    None,
    "",
    " \t\n ",
    "12 345 !!",
    "One",
    "one",
    "Two words",
    BASE,
    BASE,
    BASE.upper(),
    BASE.replace("gamma20", "delta"),
    BASE + " tail",
    BASE.replace("alpha", "omega"),
    "日本語 のテキスト 🙂 é́ café naïve",
    "a'b's 'tis   we'll\r\n\r\nx   y z\x1c\x00",
    LONG,
    "Released under the MIT License.\nsome text. All rights reserved.",
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, node long, token string"


def documents(spark, texts=TEXTS, start=1):
    """Rows with extra columns whose names operators use inside; one row has no id, one repeats."""
    rows = [(i, t, "en" if i % 2 else None, "s", len(t or ""), 0.5, 7, "x") for i, t in enumerate(texts, start)]
    if texts:
        rows += [(None, BASE, None, None, None, None, None, None), rows[7 % len(rows)]]
    return spark.createDataFrame(rows, COLUMNS)


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lowered) if w]


def shingles(text, k):
    w = words(text)
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(zip(*(w[i:] for i in range(k)), strict=False))


def smallest_reachable(nodes, links):
    """{node: smallest node reachable}."""
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            least = min(low[a], low[b])
            if (low[a], low[b]) != (least, least):
                low[a] = low[b] = least
                changed = True
    return low


def jaccard_groups(rows, k, num, den):
    """{id: (set size, smallest id reachable)} by comparing all pairs."""
    sets = {i: shingles(t, k) for i, t in rows}
    ids = sorted(sets)
    links = []
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            shared = len(x & y)
            if x and y and shared * den >= num * (len(x) + len(y) - shared):
                links.append((a, b))
    low = smallest_reachable(ids, links)
    return {i: (len(sets[i]), low[i]) for i in ids}


def bigrams(found):
    return {f"{a} {b}" for a, b in pairwise(found)}
