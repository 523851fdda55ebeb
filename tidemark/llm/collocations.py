"""Collocation mining by Toivonen's sampling, exact over all texts.

Phrases of a sample that reach a lowered threshold are the proposal. A pass
over all texts counts the proposed phrases and their negative border: words
that are not proposed, and phrases that are not although their beginning and
end (all words but the last, all but the first) are. Border phrases are counted
by a hash of 48 bits; those of a hash that reaches the threshold may be
frequent, and failed the proposal. An expansion pass then counts them, and
whatever they bring into the border, by their words.

The expansion follows a phrase that is new in the border to the phrases that
it begins or ends, in the same pass: every part of a frequent phrase is as
frequent, so each frequent phrase has been counted by its words when it ends.

A task adds up what it counts and sends parcels: for each range of hashes one
row with the sorted hashes, keys and counts of the range. Ranges are put
together in numpy, so no row of Spark's is made for a single key, but for the
few that reach the threshold.

Proposal and failures reach the tasks as a Bloom filter of bounded size. What
passes it by chance is counted too, which costs time and changes no count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import Hasher, chunks, gather, lowered, mix, release
from tidemark.llm.sampling import chance
from tidemark.llm.ship import ship
from tidemark.scale import materialise

UNDETERMINED = "und"
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_SPLIT = _BREAK.copy()
_SPLIT[[0x20, 0x09]] = True
_STEP = np.uint64(0x9FB21C651E98DF25)
# Bits of the filter: so many for each phrase that could reach the threshold, within these bounds.
_BITS_EACH, _LEAST_BITS, _MOST_BITS = 8, 20, 30
_SLICES = 64
_PARTS = 64
# What is counted goes by a hash, the words of a language and phrase, or a language alone (its number of words).
_HASH, _PHRASE, _LANGUAGE = 0, 1, 2
# Of a phrase's hash so many bits are counted, and the filter has two places for them.
_KEPT, _SECOND = 48, 18
# A task packs what it has counted when it holds so many bytes.
_HELD_BYTES = 1 << 25
# Parts are ranges of hashes, each for so many bytes of text; 2^6 to 2^16 of them.
_PART_BYTES, _LEAST_POWER, _MOST_POWER = 1 << 24, 6, 16
# A hash is packed as its lower 32 bits among those of its upper bits, with a count of one byte.
_HEADS, _MOST_TIMES = 1 << (_KEPT - 32), 255


@dataclass(frozen=True)
class Mining:
    """What counts as frequent, and the sample that proposes it."""

    least: int = 100
    words: int = 5
    share: float = 0.1
    # Of the count expected in the sample: lower proposes more and misses less.
    ease: float = 0.4
    seed: int = 23

    @property
    def least_in_sample(self) -> int:
        return max(2, round(self.least * self.share * self.ease))


class Grams:
    """The words of a chunk with a 64-bit hash each, and which follow each other in one piece."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        n = len(raw)
        self.hasher = Hasher(lowered(raw))
        split = _SPLIT[raw]
        edges = offsets[(offsets > 0) & (offsets < n)]
        begins, ends = ~split, ~split
        begins[1:] &= split[:-1]
        ends[:-1] &= split[1:]
        begins[edges] = ~split[edges]
        ends[edges - 1] = ~split[edges - 1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first_word = np.searchsorted(self.starts, offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first_word))
        # What follows no word, of the last one too, goes by the front and is cut off.
        self.linked = np.ones(len(self.starts) + 1, dtype=bool)
        self.linked[np.searchsorted(self.starts, np.flatnonzero(_BREAK[raw]))] = False
        self.linked[self.first_word] = False
        self.linked = self.linked[1:-1]
        self.hashes = self.hasher(self.starts, self.ends)

    def same(self, words: np.ndarray, others: np.ndarray) -> bool:
        """Whether the ``words`` equal the ``others``, each its own.

        The hash of up to eight bytes can be undone for a given length, so only the bytes of longer words are compared.
        """
        size = self.ends[words] - self.starts[words]
        if not np.array_equal(self.hashes[words], self.hashes[others]) or not np.array_equal(size, self.ends[others] - self.starts[others]):
            return False
        long = size > 8
        return self.hasher.same(self.starts, self.ends, words[long], others[long])

    def texts(self, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, bounds) of the phrases of ``k`` words that begin with the words ``first``, joined by single spaces."""
        words = (first[:, None] + np.arange(k)).reshape(-1)
        size = self.ends[words] - self.starts[words]
        inner = np.arange(len(size)) % k != k - 1
        size[inner] += 1
        ends = np.cumsum(size)
        joined = self.hasher.data[gather(self.starts[words], size)]
        joined[ends[inner] - 1] = 0x20
        return joined, np.concatenate([[0], ends[k - 1 :: k]])


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(indices that bring equal keys together, where each group begins, group sizes).

    Sorted are the upper bits of the keys and the index as one number. Keys that
    differ only below may alternate, and then have several groups each.
    """
    below = np.uint64((1 << len(keys).bit_length()) - 1)
    order = keys & ~below | np.arange(len(keys), dtype=np.uint64)
    order.sort()
    order = (order & below).astype(np.int64)
    ordered = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    begin = np.flatnonzero(new)
    return order, begin, np.diff(np.append(begin, len(keys)))


def passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the hashes may be in the filter."""
    q, mask = h >> np.uint64(64 - _KEPT), np.uint64(8 * len(bits) - 1)
    found = np.ones(len(h), dtype=bool)
    for place in (q & mask, (q >> np.uint64(_SECOND)) & mask):
        found &= (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


@dataclass
class Round:
    """One pass: the filter to count by, none to count every phrase by its hash, and that of the pass before."""

    new: np.ndarray | None = None
    old: np.ndarray | None = None


def _levels(grams: Grams, salt: np.ndarray, turn: Round, longest: int):
    """(words, hash and first word of every phrase to count, whether by its words), by length."""
    word = grams.hashes
    if not len(word):
        return
    h, at = mix(word ^ salt), np.arange(len(word))
    follow = was = reached = np.ones(len(word), dtype=bool)
    for k in range(1, longest + 1):
        if k > 1:
            left = np.flatnonzero(grams.linked if k == 2 else at[1:] == at[:-1] + 1)
            left = left[follow[left] & follow[left + 1]]
            if not len(left):
                return
            reached = was[left] & was[left + 1]
            at = at[left]
            h = mix(h[left] * _STEP + word[at + k - 1])
        if turn.new is None:
            yield k, h, at, np.zeros(len(h), dtype=bool)
            follow = was = np.ones(len(h), dtype=bool)
            continue
        follow = passes(turn.new, h)
        if turn.old is None:
            yield k, h, at, follow
            was = follow
        else:
            before = passes(turn.old, h)
            fresh = ~reached | (follow & ~before)
            yield k, h[fresh], at[fresh], fresh[fresh]
            follow, was = follow | ~reached, reached & before


def _phrase_keys(names: list[bytes], lang: np.ndarray, joined: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Language, line feed and phrase; no phrase has a line feed."""
    heads = np.frombuffer(b"".join(names), dtype=np.uint8)
    size = np.array([len(name) for name in names], dtype=np.int64)
    begin = (np.cumsum(size) - size)[lang]
    both = np.empty((len(lang), 2), dtype=np.int64)
    both[:, 0], both[:, 1] = size[lang], np.diff(bounds)
    where = np.empty_like(both)
    where[:, 0], where[:, 1] = begin, bounds[:-1] + len(heads)
    keys = np.concatenate([heads, joined])[gather(where.reshape(-1), both.reshape(-1))]
    return keys, np.concatenate([[0], np.cumsum(both.sum(axis=1))])


def _binary(data: np.ndarray, bounds: np.ndarray) -> pa.BinaryArray:
    at = pa.py_buffer(np.ascontiguousarray(bounds, dtype=np.int32))
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, at, pa.py_buffer(np.ascontiguousarray(data))])


def _batch(key: pa.Array, n: np.ndarray, h: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([key, pa.array(n, pa.int64()), pa.array(h, pa.uint64())], names=["key", "n", "hash"])


def _counts(batches, sent, longest: int) -> Iterator[pa.RecordBatch]:
    """(key, n, hash) of what a pass counts, key null for what it counts by hash; what comes again adds up."""
    turn = sent.value
    for batch in batches:
        coded = batch.column("lang").dictionary_encode()
        names = [name.encode() for name in coded.dictionary.to_pylist()]
        heads = [bytes([_PHRASE]) + name + b"\n" for name in names]
        digests = [hashlib.blake2b(name, digest_size=8).digest() for name in names]
        salts = np.frombuffer(b"".join(digests), dtype=np.uint64)
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        for first, last, raw, offsets in chunks(batch.column("text")):
            grams = Grams(raw, offsets)
            if turn.old is None:
                total = np.bincount(codes[first:last], np.diff(grams.first_word), minlength=len(names)).astype(np.int64)
                keys = [bytes([_LANGUAGE]) + name for name in names]
                yield _batch(pa.array(keys, pa.binary()), total, np.zeros(len(names), dtype=np.uint64))
            lang = codes[first:last][grams.row]
            for k, h, at, exact in _levels(grams, salts[lang], turn, longest):
                known, rest = np.flatnonzero(exact), np.flatnonzero(~exact)
                if len(rest):
                    yield _batch(pa.nulls(len(rest), pa.binary()), np.ones(len(rest), dtype=np.int64), h[rest])
                if len(known):
                    order, one, n = grouped(h[known])
                    known = known[order]
                    begin, model = at[known], at[np.repeat(known[one], n)]
                    alike = np.array_equal(lang[begin], lang[model]) and all(grams.same(begin + j, model + j) for j in range(k))
                    if not alike:  # two phrases of one hash: each occurrence goes by itself
                        one, n = np.arange(len(known)), np.ones(len(known), dtype=np.int64)
                    begin = begin[one]
                    yield _batch(_binary(*_phrase_keys(heads, lang[begin], *grams.texts(begin, k))), n, h[known[one]])


def _summed(keys: list[pa.Array], n: list[np.ndarray]) -> tuple[pa.BinaryArray, np.ndarray, np.ndarray]:
    """(the different keys, the sum of each, for each of all keys the number of its own)."""
    coded = pa.concat_arrays(keys).dictionary_encode()
    own = coded.indices.to_numpy()
    total = np.zeros(len(coded.dictionary), dtype=np.int64)
    np.add.at(total, own, np.concatenate(n))
    return coded.dictionary, total, own


def _content(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of a binary column without nulls."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, bounds, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    bounds = np.frombuffer(bounds, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def _parcel(hashes: list[np.ndarray], keyed: list[pa.RecordBatch], power: int) -> pa.RecordBatch:
    """A row for each of the 2^power parts that what was counted falls into."""
    parts = 1 << power
    q = np.concatenate([*hashes, np.zeros(0, dtype=np.uint64)]) >> np.uint64(64 - _KEPT)
    q.sort()
    begin = np.flatnonzero(np.concatenate([np.ones(min(1, len(q)), dtype=bool), q[1:] != q[:-1]]))
    n = np.diff(np.append(begin, len(q)))
    times = -(-n // _MOST_TIMES)  # a larger count takes several entries
    q, ends = np.repeat(q[begin], times), np.cumsum(times)
    each = np.full(len(q), _MOST_TIMES, dtype=np.uint8)
    each[ends - 1] = n - _MOST_TIMES * (times - 1)
    heads = np.bincount((q >> np.uint64(32)).astype(np.int64), minlength=_HEADS).astype(np.uint32)
    at = np.concatenate([[0], np.cumsum(heads.reshape(parts, -1).sum(axis=1, dtype=np.int64))])
    own = np.arange(parts + 1) * (_HEADS // parts * 4)
    columns = [_binary(heads.view(np.uint8), own), _binary(q.astype(np.uint32).view(np.uint8), at * 4), _binary(each, at)]
    filled = np.diff(at) > 0
    if keyed:
        keys, total, which = _summed([b.column(0) for b in keyed], [b.column(1).to_numpy() for b in keyed])
        h = np.empty(len(keys), dtype=np.uint64)
        h[which] = np.concatenate([b.column(2).to_numpy() for b in keyed])
        part = (h >> np.uint64(64 - power)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        data, bounds = _content(keys.take(pa.array(order)))
        at = np.searchsorted(part[order], np.arange(parts + 1))
        size = np.diff(bounds).astype(np.uint32)
        columns += [_binary(size.view(np.uint8), at * 4), _binary(total[order].view(np.uint8), at * 8), _binary(data, bounds[at])]
        filled |= np.diff(at) > 0
    else:
        columns += [_binary(np.zeros(0, dtype=np.uint8), np.zeros(parts + 1))] * 3
    parcel = pa.RecordBatch.from_arrays([pa.array(np.arange(parts, dtype=np.int32)), *columns], names=["part", "heads", "low", "times", "size", "n", "keys"])
    return parcel.filter(pa.array(filled))


def _parcels(found: Iterator[pa.RecordBatch], power: int) -> Iterator[pa.RecordBatch]:
    """What a task counts, added up and packed by parts, whenever it has gathered enough."""
    hashes, keyed, held = [], [], 0
    for batch in found:
        if batch.column(0).null_count:
            hashes.append(batch.column(2).to_numpy())
            held += 8 * len(batch)
        else:
            keyed.append(batch)
            held += batch.nbytes
        if held >= _HELD_BYTES:
            yield _parcel(hashes, keyed, power)
            hashes, keyed, held = [], [], 0
    if held:
        yield _parcel(hashes, keyed, power)
    release()


def _merged(batches, least: int, power: int) -> Iterator[pa.RecordBatch]:
    """(kind, key, q, n) of what occurs ``least`` times in the parcels of whole parts, and of the languages."""
    entries, keys, counts = [np.zeros(0, dtype=np.uint64)], [], []
    wide = _HEADS >> power
    for batch in batches:
        heads, low, each, size, n, texts = (_content(batch.column(i))[0] for i in range(1, 7))
        part = batch.column(0).to_numpy().astype(np.uint64)
        head = (part[:, None] * np.uint64(wide) + np.arange(wide, dtype=np.uint64)).reshape(-1)
        q = np.repeat(head << np.uint64(32), heads.view(np.uint32)) | low.view(np.uint32)
        entries.append(q << np.uint64(64 - _KEPT) | each)
        if len(size):
            keys.append(_binary(texts, np.concatenate([[0], np.cumsum(size.view(np.uint32), dtype=np.int64)])))
            counts.append(n.view(np.int64))
    entries = np.concatenate(entries)
    entries.sort()
    q = (entries >> np.uint64(64 - _KEPT)).astype(np.int64)
    if len(q):
        begin = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
        n = np.add.reduceat((entries & np.uint64(_MOST_TIMES)).astype(np.int64), begin)
        enough = n >= least
        q, n = q[begin[enough]], n[enough]
        yield _rows(np.full(len(q), _HASH), pa.nulls(len(q), pa.binary()), pa.array(q), n)
    if keys:
        key, n, _ = _summed(keys, counts)
        data, bounds = _content(key)
        kind = data[bounds[:-1]]
        enough = np.flatnonzero((n >= least) | (kind == _LANGUAGE))
        yield _rows(kind[enough], key.take(pa.array(enough)), pa.nulls(len(enough), pa.int64()), n[enough])
    release()


def _rows(kind: np.ndarray, key: pa.Array, q: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), key, q, pa.array(n, pa.int64())], names=["kind", "key", "q", "n"])


def _slices(batches, each: int) -> Iterator[pa.RecordBatch]:
    marks: dict[int, np.ndarray] = {}
    for batch in batches:
        number, at = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for one in np.unique(number).tolist():
            marks.setdefault(one, np.zeros(each, dtype=bool))[at[number == one]] = True
    for one, mark in marks.items():
        packed = np.packbits(mark, bitorder="little").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([one], pa.int64()), pa.array([packed], pa.binary())], names=["slice", "bits"])


def _filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """The filter of the hashes ``q``: ``_SLICES`` rows of fixed size reach the driver."""
    each, mask = bits // _SLICES, F.lit(bits - 1)
    places = F.array(F.col("q").bitwiseAND(mask), F.shiftright("q", _SECOND).bitwiseAND(mask))
    places = hashes.select(F.explode(places).alias("place"))
    places = places.select(F.floor(F.col("place") / each).cast("long").alias("slice"), F.pmod("place", F.lit(each)).alias("at"))
    built = places.repartition(_SLICES, "slice").mapInArrow(lambda b: _slices(b, each), "slice long, bits binary")
    whole = np.zeros((_SLICES, each // 8), dtype=np.uint8)
    for row in built.collect():
        whole[row["slice"]] = np.frombuffer(row["bits"], dtype=np.uint8)
    return whole.reshape(-1)


def _filter_bits(words: float, least: int) -> int:
    wanted = int(_BITS_EACH * words / least) + 1
    return 1 << min(max(wanted.bit_length(), _LEAST_BITS), _MOST_BITS)


def _power(text_bytes: float) -> int:
    """Of two, for so many parts that each has the phrases of some ``_PART_BYTES`` of text."""
    return min(max(int(text_bytes // _PART_BYTES).bit_length(), _LEAST_POWER), _MOST_POWER)


def _counted(texts: DataFrame, turn: Round, least: int, how: Mining, power: int) -> DataFrame:
    """(kind, key, q, n) of the hashes and keys that occur ``least`` times, and of the languages."""
    sent = texts.sparkSession.sparkContext.broadcast(turn)
    packed = "part int, heads binary, low binary, times binary, size binary, n binary, keys binary"
    parcels = texts.mapInArrow(lambda batches: _parcels(_counts(batches, sent, how.words), power), packed)
    parts = parcels.repartitionById(1 << power, "part")
    counted = parts.mapInArrow(lambda batches: _merged(batches, least, power), "kind int, key binary, q long, n long")
    return materialise(counted, "counted")


def _hashes(counted: DataFrame) -> DataFrame:
    return counted.where(F.col("kind") == _HASH).select("q")


def _phrases(counted: DataFrame) -> DataFrame:
    text = F.expr("substring(key, 2)").cast("string")
    phrase = F.when(F.col("kind") == _PHRASE, F.substring_index(text, "\n", -1)).otherwise("")
    size = F.when(F.col("kind") == _PHRASE, F.length(text) - F.length(F.substring_index(text, "\n", -1)) - 1)
    lang = F.substring(text, F.lit(1), F.coalesce(size, F.length(text)))
    return counted.where(F.col("kind") != _HASH).select(lang.alias("lang"), phrase.alias("phrase"), "n")


def _proposed(sample: DataFrame, how: Mining, text_bytes: int) -> np.ndarray:
    """The filter of the phrases that reach the lowered threshold in the sample."""
    counted = _counted(sample, Round(), how.least_in_sample, how, _power(text_bytes * how.words))
    words = counted.where(F.col("kind") == _LANGUAGE).agg(F.sum("n")).first()[0] or 0
    return _filter(_hashes(counted), _filter_bits(words / how.share, how.least))


def _words() -> Column:
    return F.split(F.col("phrase"), " ")


def frequent(docs: DataFrame, how: Mining = Mining()) -> DataFrame:
    """(lang, phrase, n): every phrase of at most ``how.words`` words that occurs ``how.least`` times in its language.

    The row with an empty phrase has the language's number of words. ``docs``
    needs doc_id, text and lang. Null text has no words, null lang is ``und``;
    repeated rows count each; other columns are not read; an empty table gives
    no row.
    """
    ship(docs.sparkSession)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNDETERMINED)).alias("lang")
    texts = docs.select(lang, F.col("text").cast("string").alias("text"))
    sample = docs.where(chance(how.seed, "doc_id", "text") < how.share)
    sample = materialise(sample.select(lang, F.col("text").cast("string").alias("text")), "sample")
    text_bytes = sample.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    proposed = _proposed(sample, how, text_bytes)
    power = _power(text_bytes / how.share)
    counted = _counted(texts, Round(proposed), how.least, how, power)
    found, failed = _phrases(counted), _hashes(counted)
    if not failed.isEmpty():
        wider = proposed | _filter(failed, 8 * len(proposed))
        found = found.unionAll(_phrases(_counted(texts, Round(wider, proposed), how.least, how, power)))
    return found


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(17,0)")


def collocations(docs: DataFrame, how: Mining = Mining(), top: int = 2000) -> DataFrame:
    """The ``top`` phrases of two words or more of each language by the score of their weakest cut.

    With a the phrase's count, l and r those of the parts of a cut and n the
    language's words, a cut scores floor(1000 * a * n / (l * r)), computed in
    decimals. A phrase goes if a longer frequent one holds it and is as frequent.
    """
    found = materialise(frequent(docs, how), "frequent")
    totals = materialise(found.where("phrase = ''").select("lang", F.col("n")), "totals")
    counts = found.where("phrase <> ''").select("lang", "phrase", F.col("n").alias("a"))
    longer = counts.withColumn("words", _words()).where(F.size("words") > 1)
    cuts = longer.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("cut"))
    cuts = cuts.select(
        "lang",
        "phrase",
        "a",
        "cut",
        F.concat_ws(" ", F.slice("words", F.lit(1), F.col("cut"))).alias("begin"),
        F.concat_ws(" ", F.slice("words", F.col("cut") + 1, F.size("words") - F.col("cut"))).alias("rest"),
    )
    of = {side: counts.select("lang", F.col("phrase").alias(side), F.col("a").alias(n)) for side, n in (("begin", "l"), ("rest", "r"))}
    cuts = cuts.join(of["begin"], ["lang", "begin"]).join(of["rest"], ["lang", "rest"]).join(totals, "lang")
    over = F.lit(1000).cast("decimal(4,0)") * (_exact("a") * _exact("n"))
    cuts = cuts.withColumn("over", over).withColumn("under", _exact("l") * _exact("r"))
    scored = cuts.withColumn("score", F.expr("over div under"))
    weakest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("at"))
    # A longer phrase is never more frequent than its parts, so one word more decides for all lengths.
    size = F.size("words")
    inside = F.array(
        F.concat_ws(" ", F.slice("words", F.lit(1), size - 1)), F.concat_ws(" ", F.slice("words", F.lit(2), size - 1))
    )
    held = longer.where(size > 2).select("lang", F.explode(inside).alias("phrase"), F.col("a").alias("held"))
    held = held.groupBy("lang", "phrase").agg(F.max("held").alias("held"))
    kept = weakest.join(held, ["lang", "phrase"], "left").where("held is null or held < a")
    kept = kept.select("lang", "phrase", "a", F.col("at.l").alias("l"), F.col("at.r").alias("r"), "n", F.col("at.score").alias("score"))
    return _first(kept, top)


def _first(rows: DataFrame, top: int) -> DataFrame:
    """The first rows of each language; parts of it are cut down before they meet."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    part = F.pmod(F.xxhash64("phrase"), F.lit(_PARTS))
    rows = rows.withColumn("part", part).withColumn("nth", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    rows = rows.where(F.col("nth") <= top).drop("part", "nth")
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
