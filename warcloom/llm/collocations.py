"""Phrase collocation mining with mergeable Misra-Gries summaries.

Phrases of two to four words are counted per language in passes over the texts:

1. Words are counted exactly.
2. Pairs of frequent words, then phrases of three and four words whose pairs are
   all frequent, are summarised: each n-gram belongs to one hash partition, and a
   partition keeps a Misra-Gries summary of them. Its capacity exceeds the
   partition's mass divided by the threshold, so the summary's error stays below
   the threshold and every frequent n-gram survives. Tasks send what they have
   added up; the summaries of tasks are merged in the partition, in memory that
   does not depend on how many n-grams there are.
3. The partition's rows, which hold each task's exact counts, are read a second
   time and added up for the survivors and for what shares a filter slot with one.
   A task sends a phrase's words only from texts of the smallest ``home`` (a hash of
   the text) that the phrase has, so about one row per phrase, not one per task.
4. 64-bit names may stand for two phrases. Each task adds up a second hash over all
   occurrences, in a fixed number of buckets; where the sums differ from count times
   hash of the phrases found, the bucket's phrases are counted by their words.

A phrase is never more frequent than its parts, so leaving out n-grams with an
infrequent part loses nothing. What is frequent reaches the tasks as bitmaps of
a fixed size (``filter_bits``); a false positive costs work, not correctness.
Texts are cut into blocks between pieces only, so whole texts are read.

Defined cases: null text is empty; a null language is ``und``; repeated rows
count as often as they stand there; empty tables give an empty result; other
columns are not read. Ties are ordered down to the phrase, so ranks are unique.
"""

from __future__ import annotations

import hashlib
import re
import tempfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import mix64

LONGEST = 4
#: Texts are handled in blocks of about this many bytes, which bounds memory.
BLOCK_BYTES = 500_000
#: Distinct n-grams a task adds up before it sends them on.
_HELD = 500_000
#: Counters that a hash partition's summary should need; there are as many partitions as that takes.
_COUNTERS = 400_000
#: Bytes of a partition's rows that a task keeps in memory; more go to its temporary folder.
_ASIDE = 1 << 24
#: Bits of a text's ``home``, which are sent in the low bits of a count.
_HOME = 12
#: Buckets of phrases whose second hashes are compared as sums.
_BUCKETS = 1024

_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x09]] = True
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BREAKS = re.compile(rb"[.,;:!?\x0a-\x0d]")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SLOT = mix64(np.arange(11, 11 + LONGEST, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
_SEEDS = (np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93))
_BYTES = tuple(mix64(np.arange(1, 257, dtype=np.uint64) * seed) for seed in _SEEDS)


@dataclass
class _Block:
    """Words of some texts: places, hashes (one or two families), piece numbers, languages, homes of their texts."""

    data: bytes
    start: np.ndarray
    stop: np.ndarray
    hashes: list[np.ndarray]
    piece: np.ndarray
    lang: np.ndarray
    home: np.ndarray
    names: list[str]

    def phrase(self, first: int, n: int) -> str:
        return b" ".join(self.data[self.start[i]:self.stop[i]] for i in range(first, first + n)).decode()


def _lang_hash(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")


def _parts(text: bytes) -> Iterator[bytes]:
    """A text in parts of about a block; cut between pieces only."""
    at = 0
    while len(text) - at > BLOCK_BYTES:
        ends = _BREAKS.search(text, at + BLOCK_BYTES)
        if not ends:
            break
        yield text[at:ends.end()]
        at = ends.end()
    yield text[at:]


def _read(parts: list[tuple[bytes, str]], families: int) -> _Block:
    names = sorted({lang for _, lang in parts})
    number = {name: i for i, name in enumerate(names)}
    # A line break after each part ends its last piece.
    joined = b"\n".join(part for part, _ in parts) + b"\n"
    data = np.frombuffer(joined, np.uint8)
    breaks = _BREAK[data]
    inside = np.flatnonzero(~(breaks | _GAP[data]))
    if not len(inside):
        none = np.zeros(0, np.int64)
        return _Block(joined, none, none, [none.view(np.uint64)] * families, none, none, none.astype(np.int16), names)
    first = np.flatnonzero(np.diff(inside, prepend=-2) > 1)
    length = np.diff(first, append=len(inside))
    start = inside[first]
    offset = np.arange(len(inside)) - np.repeat(first, length)
    weights = mix64(np.arange(1, int(length.max()) + 1, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB)) | np.uint64(1)
    weight = weights[offset]
    hashes = [mix64(np.add.reduceat(table[data[inside]] * weight, first) + length.astype(np.uint64)) for table in _BYTES[:families]]
    part_starts = np.cumsum([0] + [len(part) + 1 for part, _ in parts])[:-1]
    langs = np.array([number[lang] for _, lang in parts])
    homes = np.array([zlib.crc32(part) >> 32 - _HOME for part, _ in parts], np.int16)
    part = np.searchsorted(part_starts, start, "right") - 1
    return _Block(joined, start, start + length, hashes, np.cumsum(breaks)[start], langs[part], homes[part], names)


def _blocks(batches: Iterator[pa.RecordBatch], families: int = 1) -> Iterator[_Block]:
    held: list[tuple[bytes, str]] = []
    size = 0
    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang"), strict=True):
            if not text.is_valid:
                continue
            for part in _parts(text.as_py().encode().translate(_LOWER)):
                held.append((part, lang.as_py()))
                size += len(part)
                if size > BLOCK_BYTES:
                    yield _read(held, families)
                    held, size = [], 0
    if held:
        yield _read(held, families)


def _grams(block: _Block, n: int, family: int = 0) -> np.ndarray:
    """The hash of the n-gram at each word; of its language and words."""
    word = block.hashes[family]
    m = max(0, len(word) - n + 1)
    total = np.array([_lang_hash(name) for name in block.names] or [0], np.uint64)[block.lang[:m]]
    for j in range(n):
        total = total + word[j:m + j] * _SLOT[j]
    return mix64(total + np.uint64(n))


def _whole(block: _Block, n: int) -> np.ndarray:
    """Where an n-gram lies inside one piece."""
    m = max(0, len(block.start) - n + 1)
    return block.piece[:m] == block.piece[n - 1:n - 1 + m]


class _Filter:
    """A bitmap of 64-bit names."""

    def __init__(self, bits: np.ndarray, size: int):
        self.bits, self.shift = bits, np.uint64(64 - size)

    def __call__(self, names: np.ndarray) -> np.ndarray:
        slot = names >> self.shift
        return (self.bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def _filter(names: DataFrame, size: int) -> _Filter:
    """Bitmap of 2 ** size bits of the column ``gram``, at most 2 ** (size - 6) rows for the driver."""
    words = (
        names.select(F.shiftrightunsigned("gram", 64 - size).alias("slot")).groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("bits")).toPandas()
    )
    bits = np.zeros(1 << (size - 6), np.uint64)
    if len(words):
        bits[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return _Filter(bits, size)


class _Counter:
    """Exact counts of phrases that a task has met.

    Phrases are looked up by one hash and told apart by a second one; where two
    phrases share the first, the later one's occurrences are sent one by one.
    """

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.checks = np.zeros(0, np.uint64)
        self.counts = np.zeros(0, np.int64)
        self.place = np.zeros(0, np.int64)
        self.shown: list[tuple[str, int, str]] = []
        self.apart: list[tuple[str, int, str, int]] = []

    def add(self, block: _Block, n: int, at: np.ndarray, keys: np.ndarray, checks: np.ndarray) -> None:
        if not len(at):
            return
        values, first, inverse, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        expected = checks[first].copy()
        spot = np.minimum(np.searchsorted(self.keys, values), max(len(self.keys) - 1, 0))
        known = self.keys[spot] == values if len(self.keys) else np.zeros(len(values), bool)
        expected[known] = self.checks[spot[known]]
        differ = checks != expected[inverse]
        if differ.any():
            for i in np.flatnonzero(differ):
                lang = block.names[block.lang[at[i]]]
                self.apart.append((lang, n, block.phrase(int(at[i]), n), int(keys[i].view(np.int64))))
            counts = counts - np.bincount(inverse[differ], minlength=len(values))
        self.counts[spot[known]] += counts[known]
        fresh = ~known
        if fresh.any():
            places = len(self.shown) + np.arange(int(fresh.sum()))
            for i in at[first[fresh]].tolist():
                self.shown.append((block.names[block.lang[i]], n, block.phrase(i, n)))
            merged = np.concatenate([self.keys, values[fresh]])
            order = np.argsort(merged, kind="stable")
            self.keys = merged[order]
            self.checks = np.concatenate([self.checks, expected[fresh]])[order]
            self.counts = np.concatenate([self.counts, counts[fresh]])[order]
            self.place = np.concatenate([self.place, places])[order]

    def __len__(self) -> int:
        return len(self.shown) + len(self.apart)

    def rows(self) -> Iterator[pa.RecordBatch]:
        by_place = np.argsort(self.place)
        counts = self.counts[by_place].tolist() + [1] * len(self.apart)
        grams = self.keys[by_place].view(np.int64).tolist() + [a[3] for a in self.apart]
        shown = self.shown + [a[:3] for a in self.apart]
        for i in range(0, len(shown), 50_000):
            part = shown[i:i + 50_000]
            yield pa.record_batch({
                "lang": pa.array([s[0] for s in part], pa.string()), "words": pa.array([s[1] for s in part], pa.int32()),
                "phrase": pa.array([s[2] for s in part], pa.string()), "gram": pa.array(grams[i:i + 50_000], pa.int64()),
                "f": pa.array(counts[i:i + 50_000], pa.int64()),
            })
        self.clear()


_COUNTED = "lang string, words int, phrase string, gram long, f long"
_SENT = "gram long, seen long"


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their counts, and per language one row without a phrase: all word occurrences."""
    counter, total = _Counter(), {}
    for block in _blocks(batches, 2):
        for i, n in enumerate(np.bincount(block.lang, minlength=len(block.names)).tolist()):
            total[block.names[i]] = total.get(block.names[i], 0) + n
        counter.add(block, 1, np.arange(len(block.start)), _grams(block, 1), _grams(block, 1, 1))
        if len(counter) > _HELD:
            yield from counter.rows()
    yield from counter.rows()
    k = len(total)
    yield pa.record_batch({
        "lang": pa.array(list(total), pa.string()), "words": pa.array([0] * k, pa.int32()), "phrase": pa.nulls(k, pa.string()),
        "gram": pa.nulls(k, pa.int64()), "f": pa.array(list(total.values()), pa.int64()),
    })


def _kept(block: _Block, lengths: tuple[int, ...], words: _Filter, pairs: _Filter | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, places, hashes) of the n-grams inside a piece whose words, or pairs for n > 2, all pass."""
    word = words(_grams(block, 1))
    pair = _whole(block, 2) & word[:-1] & word[1:]
    if pairs is not None:
        at = np.flatnonzero(pair)
        pair[at] = pairs(_grams(block, 2)[at])
    for n in lengths:
        good = pair
        for j in range(1, n - 1):
            m = max(0, len(word) - n + 1)
            good = good[:m] & pair[j:j + m]
        good = good[:max(0, len(word) - n + 1)] & _whole(block, n)
        at = np.flatnonzero(good)
        yield n, at, _grams(block, n)[at]


def _summed(keys: list[np.ndarray], counts: list[np.ndarray], homes: list[np.ndarray] | None = None) -> tuple[np.ndarray, ...]:
    """Each key once with the sum of its counts and, if given, its smallest home."""
    if not keys:
        return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * (1 if homes is None else 2)
    key = np.concatenate(keys)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    columns = [(np.add, counts)] + ([] if homes is None else [(np.minimum, homes)])
    values = [(how, np.concatenate(column)[order]) for how, column in columns]
    return key[first], *(how.reduceat(value, first) if len(first) else value for how, value in values)


def _send(batches: Iterator[pa.RecordBatch], lengths: tuple[int, ...], words: _Filter, pairs: _Filter | None) -> Iterator[pa.RecordBatch]:
    """(gram, seen) of a task's n-grams, added up: exact counts, the smallest home in the low bits."""
    keys: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    homes: list[np.ndarray] = []
    held = 0

    def out() -> Iterator[pa.RecordBatch]:
        key, count, home = _summed(keys, counts, homes)
        seen = count << _HOME | home
        for i in range(0, len(key), 200_000):
            yield pa.record_batch({"gram": pa.array(key[i:i + 200_000].view(np.int64)), "seen": pa.array(seen[i:i + 200_000])})

    for block in _blocks(batches):
        for _, at, grams in _kept(block, lengths, words, pairs):
            key, count, home = _summed([grams], [np.ones(len(grams), np.int64)], [block.home[at]])
            keys.append(key)
            counts.append(count)
            homes.append(home)
            held += len(key)
        if held > 4 * _HELD:
            key, count, home = _summed(keys, counts, homes)
            keys, counts, homes, held = [key], [count], [home], len(key)
            if held > 2 * _HELD:
                yield from out()
                keys, counts, homes, held = [], [], [], 0
    yield from out()


class Summary:
    """A Misra-Gries summary: counts that fall short by at most ``error``, of every item above it.

    Summaries are merged by adding their counts; what exceeds ``capacity`` is cut by
    taking the (capacity + 1)-th largest count off all. If more mass comes than the
    capacity was planned for, it grows rather than let the error reach ``threshold``.
    """

    def __init__(self, capacity: int, threshold: int):
        self.capacity, self.threshold, self.error = max(1, capacity), threshold, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.held += len(keys)
        if self.held > self.capacity:
            self.merge()

    def merge(self) -> None:
        self.keys, self.counts = _summed([self.keys, *(k for k, _ in self.waiting)], [self.counts, *(c for _, c in self.waiting)])
        self.waiting, self.held = [], 0
        if len(self.keys) <= self.capacity:
            return
        cut = int(np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1])
        if self.error + cut >= self.threshold:
            self.capacity = 2 * len(self.keys)
            return
        self.error += cut
        kept = self.counts > cut
        self.keys, self.counts = self.keys[kept], self.counts[kept] - cut

    def survivors(self) -> np.ndarray:
        """Every item that may reach the threshold."""
        self.merge()
        return self.keys[self.counts + self.error >= self.threshold]


def _counted(sent: DataFrame, mass: int, threshold: int, filter_bits: int) -> DataFrame:
    """(gram, f, home): exact counts and smallest homes of the n-grams that may reach the threshold.

    A summary per hash partition names the candidates. The partition's rows are kept
    aside, on the task's disk where they are many, and then added up where their
    filter slot is a candidate's.
    """
    session = sent.sparkSession
    partitions = max(int(session.conf.get("spark.sql.shuffle.partitions")), -(-mass // (threshold * _COUNTERS)))
    capacity = 2 * mass // (partitions * threshold) + 1
    shift = 64 - filter_bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(capacity, threshold)
        with tempfile.SpooledTemporaryFile(_ASIDE) as aside:
            for batch in batches:
                grams, seen = batch.column("gram").to_numpy(), batch.column("seen").to_numpy()
                summary.add(grams.view(np.uint64), seen >> _HOME)
                aside.write(np.stack([grams, seen], axis=1).tobytes())
            slots = np.unique(summary.survivors() >> np.uint64(shift))
            aside.seek(0)
            held: list[tuple[np.ndarray, ...]] = []
            while len(slots) and (rows := aside.read(16 * _HELD)):
                grams, seen = np.frombuffer(rows, np.int64).reshape(-1, 2).T
                slot = grams.view(np.uint64) >> np.uint64(shift)
                mine = slots[np.minimum(np.searchsorted(slots, slot), len(slots) - 1)] == slot
                held.append((grams[mine].view(np.uint64), seen[mine] >> _HOME, seen[mine] & (1 << _HOME) - 1))
                held = [_summed(*map(list, zip(*held, strict=True)))]
        if held:
            gram, f, home = held[0]
            for i in range(0, len(gram), 200_000):
                yield pa.record_batch({
                    "gram": pa.array(gram[i:i + 200_000].view(np.int64)), "f": pa.array(f[i:i + 200_000]), "home": pa.array(home[i:i + 200_000])})

    return sent.repartition(partitions, F.shiftrightunsigned("gram", shift)).mapInArrow(count, "gram long, f long, home long")


def _passing(block: _Block, words: _Filter, pairs: _Filter, longer: _Filter) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(n, places, hashes, second hashes) of the n-grams that ``_counted`` has counted."""
    for n, at, grams in _kept(block, tuple(range(2, LONGEST + 1)), words, pairs):
        if n > 2:
            passed = longer(grams)
            at, grams = at[passed], grams[passed]
        yield n, at, grams, _grams(block, n, 1)[at]


def _bucket(grams: np.ndarray) -> np.ndarray:
    return (grams & np.uint64(_BUCKETS - 1)).astype(np.int64)


_NAMED = "lang string, words int, phrase string, gram long, mark long"


def _name(batches: Iterator[pa.RecordBatch], words: _Filter, pairs: _Filter, longer: _Filter, homes: _Filter) -> Iterator[pa.RecordBatch]:
    """Phrases from the texts of their homes, and per bucket one row without a phrase: the sum of all occurrences' marks."""
    told: set[int] = set()
    rows: list[tuple[str | None, int, str | None, int, int]] = []
    sums = np.zeros(_BUCKETS, np.int64)

    def out() -> pa.RecordBatch:
        types = (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64())
        columns = zip(*rows, strict=True) if rows else [()] * len(types)
        return pa.record_batch(
            [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)], ["lang", "words", "phrase", "gram", "mark"])

    for block in _blocks(batches, 2):
        for n, at, grams, checks in _passing(block, words, pairs, longer):
            marks = (checks >> np.uint64(32)).astype(np.int64)
            np.add.at(sums, _bucket(grams), marks)
            mine = np.flatnonzero(homes(grams ^ block.home[at].astype(np.uint64) << np.uint64(64 - _HOME)))
            values, first = np.unique(grams[mine], return_index=True)
            places = at[mine[first]].tolist()
            for gram, i, mark in zip(values.view(np.int64).tolist(), places, marks[mine[first]].tolist(), strict=True):
                if gram not in told:
                    told.add(gram)
                    rows.append((block.names[block.lang[i]], n, block.phrase(i, n), gram, mark))
        if len(rows) > 50_000:
            yield out()
            rows = []
        if len(told) > _HELD:
            told.clear()
    rows += [(None, 0, None, i, int(sums[i])) for i in np.flatnonzero(sums).tolist()]
    yield out()


def _count_again(batches: Iterator[pa.RecordBatch], words: _Filter, pairs: _Filter, longer: _Filter, buckets: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Phrases of some buckets, counted by their words."""
    counter = _Counter()
    for block in _blocks(batches, 2):
        for n, at, grams, checks in _passing(block, words, pairs, longer):
            wanted = buckets[_bucket(grams)]
            counter.add(block, n, at[wanted], grams[wanted], checks[wanted])
        if len(counter) > _HELD:
            yield from counter.rows()
    yield from counter.rows()


def phrase_counts(docs: DataFrame, threshold: int = 30, text_col: str = "text", lang_col: str = "lang", filter_bits: int = 26) -> tuple[DataFrame, DataFrame]:
    """(counts, totals): exact counts of every phrase of one to four words seen ``threshold`` times or
    more in its language (lang, words, phrase, f), and all word occurrences of a language (lang, n).
    """
    texts = docs.select(F.col(text_col).alias("text"), F.coalesce(lang_col, F.lit("und")).alias("lang"))

    def over(fn: Callable, schema: str) -> DataFrame:
        return texts.mapInArrow(fn, schema)

    def added(rows: DataFrame) -> DataFrame:
        return rows.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"), F.first("gram").alias("gram"))

    singles = cut_lineage(added(over(_count_words, _COUNTED)).where((F.col("f") >= threshold) | F.col("phrase").isNull()))
    totals = singles.where("phrase IS NULL").select("lang", F.col("f").alias("n"))
    singles = singles.where("phrase IS NOT NULL")
    # A text has fewer pairs than words, and so on; this bounds the mass of the summaries.
    mass = int(totals.agg(F.sum("n")).first()[0] or 0)
    words = _filter(singles, filter_bits)
    two = cut_lineage(_counted(over(lambda it: _send(it, (2,), words, None), _SENT), mass, threshold, filter_bits))
    pairs = _filter(two, filter_bits)
    more = cut_lineage(_counted(over(lambda it: _send(it, (3, 4), words, pairs), _SENT), 2 * mass, threshold, filter_bits))
    longer = _filter(more, filter_bits)
    found = two.union(more)
    homes = _filter(found.select(F.expr(f"gram ^ shiftleft(home, {64 - _HOME})").alias("gram")), filter_bits)
    mark = F.col("mark").cast("decimal(38,0)")
    named = cut_lineage(
        over(lambda it: _name(it, words, pairs, longer, homes), _NAMED)
        .groupBy("lang", "words", "phrase", "gram").agg(F.max("mark").alias("mark"), F.sum(mark).alias("total")))
    bucket = F.col("gram").bitwiseAND(_BUCKETS - 1)
    phrases = named.where("phrase IS NOT NULL").join(found.select("gram", "f"), "gram").withColumn("bucket", bucket)
    expected = phrases.groupBy("bucket").agg(F.sum(F.col("f") * mark).alias("expected"))
    sums = named.where("phrase IS NULL").select(F.col("gram").alias("bucket"), "total")
    differ = sums.join(expected, "bucket", "full").where(~F.col("total").eqNullSafe(F.col("expected"))).select("bucket").toPandas()
    phrases = phrases.select("lang", "words", "phrase", "f", "gram", "bucket")
    if len(differ):
        again = np.zeros(_BUCKETS, bool)
        again[differ["bucket"].to_numpy(np.int64)] = True
        phrases = phrases.where(~F.col("bucket").isin(np.flatnonzero(again).tolist())).drop("bucket").union(
            added(over(lambda it: _count_again(it, words, pairs, longer, again), _COUNTED)))
    phrases = phrases.select("lang", "words", "phrase", "f", "gram").where(F.col("f") >= threshold)
    return cut_lineage(singles.union(phrases).select("lang", "words", "phrase", "f")), totals


def collocations(docs: DataFrame, threshold: int = 30, top: int = 2000, contained: int = 80, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases.

    A phrase is cut after its first k words into parts of l and r occurrences; the
    lowest floor(2000000 a / (l + r)) counts, ties to the smallest k. Phrases inside a
    longer frequent one that has ``contained`` per cent of their occurrences or more
    are dropped. Order: score and a descending, then phrase by its bytes.
    """
    counts, totals = phrase_counts(docs, threshold, text_col, lang_col)
    found = counts.where("words > 1").withColumn("w", F.split("phrase", " "))

    def joined(first, n):
        return F.array_join(F.slice("w", first, n), " ")

    spans = [(n, i, k) for n in range(3, LONGEST + 1) for k in range(2, n) for i in range(1, n - k + 2)]
    inner = F.filter(F.array(*[F.when(F.col("words") == n, joined(i, k)) for n, i, k in spans]), lambda s: s.isNotNull())
    inside = (
        found.where("words > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), F.col("f").alias("longer"))
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    )
    exact = "decimal(38,0)"
    kept = found.join(inside, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer").cast(exact) * 100 < F.col("f").cast(exact) * contained))
    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), "words", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("left"), joined(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    parts = counts.where(F.col("words") < LONGEST).select("lang", "phrase", "f")
    scored = (
        cuts.join(parts.toDF("lang", "left", "l"), ["lang", "left"]).join(parts.toDF("lang", "right", "r"), ["lang", "right"])
        .withColumn("score", F.expr(f"(CAST(a AS {exact}) * 2000000) div (CAST(l AS {exact}) + CAST(r AS {exact}))"))
        .groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("best"))
        .select("lang", "phrase", "best.*")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
