"""Benchmark passages in texts, by the q-gram lemma and banded alignment.

Texts and benchmark items are compared as runs of lower-case letters and digits
with single spaces between. Each item is cut into equal segments of at most
``segment_chars``, and besides into overlapping windows of ``WINDOW`` characters,
one every ``STEP``, so that a text which holds part of an item is found wherever
the part begins: a verbatim passage of WINDOW + STEP - 1 = 47 characters holds a
whole window. Items under 100 characters have windows of two fifths of their
length, but of 30 characters at least. A segment or window of m characters within
k = floor(edit_rate * m) edits of a text region shares at least m - q + 1 - k * q
q-grams with it, and those lie on at most k + 1 neighbouring diagonals (text
position minus segment position).

1. All q-grams of a text are hashed and looked up among those of the items.
2. Hits are counted per (segment, diagonal band). Bands of 2 (k + 1) diagonals
   overlap by half, so any k + 1 neighbouring diagonals lie in one of them.
3. Bands that reach the lemma's bound are kept as regions, and each is verified
   by an edit-distance alignment that visits only the band.

The benchmark is a stated query set. It is taken in blocks of at most
``block_chars`` characters, each broadcast and held against every text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64

_NOISE = re.compile(r"[\W_]+")
Q = 12
#: Characters of a window (of a short item: at least), and from one window's start to the next.
WINDOW, SHORT_WINDOW, STEP = 40, 30, 8
#: Shared q-grams that a window needs at least; its edit budget is lowered to fit.
_WINDOW_GRAMS = 5
#: Texts are scanned in blocks of about this many characters, which bounds memory.
SCAN_CHARS = 2_000_000
_TABLE_BITS = 22


def plain_form(text: str | None) -> str:
    return _NOISE.sub(" ", (text or "").lower()).strip()


def gram_hashes(data: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of each run of q values, by doubling: 1, 2, 4, 8, then the rest."""
    if len(data) < q:
        return np.zeros(0, np.uint64)
    powers = {1: data.astype(np.uint64)}
    width = 1
    while width * 2 <= q:
        half = powers[width]
        factor = np.uint64(0x9E3779B97F4A7C15 ^ (width * 0x5851F42D4C957F2D & 0xFFFFFFFFFFFFFFFF) | 1)
        powers[width * 2] = half[:-width] * factor + (half[width:] ^ (half[width:] >> np.uint64(17)))
        width *= 2
    total, at = None, 0
    count = len(data) - q + 1
    for width in sorted(powers, reverse=True):
        if q - at >= width:
            piece = powers[width][at:at + count]
            total = piece if total is None else total * np.uint64(0xD1342543DE82EF95) + piece
            at += width
    return mix64(total)


@dataclass
class SegmentIndex:
    """Segments and windows of a benchmark block with the q-grams of its items.

    ``items``, ``texts``, ``begins``, ``edits`` and ``bounds`` have an entry for
    each segment or window. A q-gram is kept once for each place in an item:
    the place, the segment that holds it (or -1), and the first window that holds
    it and how many do, for windows are listed in order.
    """

    items: list[int]
    texts: list[str]
    begins: np.ndarray
    edits: np.ndarray
    bounds: np.ndarray
    grams: np.ndarray
    starts: np.ndarray
    place: np.ndarray
    segment: np.ndarray
    window: np.ndarray
    windows: np.ndarray
    table: np.ndarray


def segments_of(text: str, segment_chars: int) -> list[str]:
    plain = plain_form(text)
    if not plain:
        return []
    pieces = -(-len(plain) // segment_chars)
    size = -(-len(plain) // pieces)
    return [plain[i:i + size] for i in range(0, len(plain), size)]


def windows_of(plain: str) -> tuple[int, list[int]]:
    """Length and starts of an item's windows; none where the item is no longer than one."""
    size = max(SHORT_WINDOW, min(WINDOW, len(plain) * 2 // 5))
    last = len(plain) - size
    if last <= 0:
        return size, []
    return size, [*range(0, last, STEP), last]


def build_index(rows: list[tuple[int, str]], edit_rate: float, segment_chars: int, q: int = Q) -> SegmentIndex:
    """Segments too short for a positive bound take a lower edit budget, down to 0 edits; those shorter than q are left out."""
    items, texts, begins, edits, bounds = [], [], [], [], []
    hashes, places, segment, window, windows = [], [], [], [], []

    def add(item: int, text: str, begin: int, least: int) -> int:
        m = len(text)
        k = min(int(edit_rate * m), max(0, (m - q + 1 - least) // q))
        items.append(item)
        texts.append(text)
        begins.append(begin)
        edits.append(k)
        bounds.append(max(1, m - q + 1 - k * q))
        return len(items) - 1

    for item, text in rows:
        plain = plain_form(text)
        if len(plain) < q:
            continue  # nothing to hold against the lemma; see the docstring of leaks
        place = np.arange(len(plain) - q + 1, dtype=np.int32)
        held = np.full(len(place), -1, np.int32)
        begin = 0
        for piece in segments_of(text, segment_chars):
            if len(piece) >= q:
                held[begin:begin + len(piece) - q + 1] = add(item, piece, begin, 1)
            begin += len(piece)
        size, at = windows_of(plain)
        first = len(items)
        for begin in at:
            add(item, plain[begin:begin + size], begin, _WINDOW_GRAMS)
        # Windows that hold the q-gram at p begin at p - size + q up to p.
        low = np.searchsorted(at, place - size + q, "left")
        high = np.searchsorted(at, place, "right")
        hashes.append(gram_hashes(np.frombuffer(plain.encode("utf-32-le"), np.uint32), q))
        places.append(place)
        segment.append(held)
        window.append((first + low).astype(np.int32))
        windows.append((high - low).astype(np.int32))
    flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    grams, starts = np.unique(flat[order], return_index=True)
    table = np.zeros(1 << _TABLE_BITS, bool)
    table[(grams >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True

    def sorted_by_gram(parts: list[np.ndarray]) -> np.ndarray:
        return np.concatenate(parts)[order] if parts else np.zeros(0, np.int32)

    return SegmentIndex(
        items, texts, np.array(begins, np.int64), np.array(edits, np.int64), np.array(bounds, np.int64), grams,
        np.append(starts, len(flat)).astype(np.int64),
        *map(sorted_by_gram, (places, segment, window, windows)), table,
    )


def banded_distance(segment: str, region: str, low: int, high: int, limit: int) -> tuple[int, int] | None:
    """Least edits between the segment and any part of the region, and where that part ends.

    Only cells with low <= region position - segment position <= high are
    visited. None when the least is over the limit.
    """
    exact = region.find(segment, max(0, low), max(0, min(len(region), high + len(segment))))
    if exact >= 0:
        return 0, exact + len(segment)
    infinite = limit + 1
    previous = {j: 0 for j in range(max(0, low), min(len(region), high) + 1)}
    for i, letter in enumerate(segment, 1):
        row: dict[int, int] = {}
        best = infinite
        for j in range(max(0, i + low), min(len(region), i + high) + 1):
            value = previous.get(j, infinite) + 1
            if j > 0:
                value = min(value, row.get(j - 1, infinite) + 1, previous.get(j - 1, infinite) + (region[j - 1] != letter))
            row[j] = value = min(value, infinite)
            best = min(best, value)
        if best > limit:
            return None
        previous = row
    distance, end = min((v, j) for j, v in previous.items())
    return (distance, end) if distance <= limit else None


def _ranges(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each range, ``many`` numbers each."""
    return np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)


def _regions(index: SegmentIndex, data: np.ndarray, q: int) -> list[tuple[int, int, int]]:
    """(segment, lowest diagonal, highest diagonal) of the bands that reach the bound."""
    if len(data) < q or not len(index.grams):
        return []
    hashes = gram_hashes(data, q)
    maybe = np.flatnonzero(index.table[(hashes >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)])
    if not len(maybe):
        return []
    at = np.minimum(np.searchsorted(index.grams, hashes[maybe]), len(index.grams) - 1)
    found = index.grams[at] == hashes[maybe]
    maybe, at = maybe[found], at[found]
    if not len(maybe):
        return []
    many = index.starts[at + 1] - index.starts[at]
    entry = _ranges(index.starts[at], many)
    diagonal = np.repeat(maybe, many) - index.place[entry]
    inside, many = index.segment[entry] >= 0, index.windows[entry]
    segment = np.concatenate([index.segment[entry[inside]], _ranges(index.window[entry], many)]).astype(np.int64)
    diagonal = np.concatenate([diagonal[inside], np.repeat(diagonal, many)]) + index.begins[segment]
    half = index.edits[segment] + 1
    # Band b covers diagonals b * half up to (b + 2) * half; each diagonal lies in two bands.
    band = np.floor_divide(diagonal, half)
    keys = np.stack([np.concatenate([segment, segment]), np.concatenate([band, band - 1])])
    bands, counts = np.unique(keys, axis=1, return_counts=True)
    good = counts >= index.bounds[bands[0]]
    out = []
    for s, b in bands[:, good].T:
        width = int(index.edits[s]) + 1
        out.append((int(s), int(b) * width, (int(b) + 2) * width - 1))
    return out


def scan(index: SegmentIndex, texts: list[str | None], q: int = Q) -> Iterator[tuple[int, int, int, int, int]]:
    """(text number, segment, start, end, edits) in the plain form of each text."""
    block: list[str] = []
    first = size = 0

    def run() -> Iterator[tuple[int, int, int, int, int]]:
        joined = ("\n" * q).join(block)  # no q-gram of a segment holds a line break
        data = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        starts = np.cumsum([0] + [len(t) + q for t in block])
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for s, low, high in _regions(index, data, q):
            segment, k = index.texts[s], int(index.edits[s])
            # The region's text: its diagonals, the segment's length and room for the edits.
            owner = int(np.searchsorted(starts, max(0, (low + high) // 2 + len(segment) // 2), "right")) - 1
            owner = min(max(owner, 0), len(block) - 1)
            text, base = block[owner], int(starts[owner])
            key = (owner, s)
            if key in best and not best[key][0]:
                continue  # regions come in order, so this one lies behind
            begin = max(0, low - base - k)
            region = text[begin:max(0, high - base + len(segment) + k)]
            got = banded_distance(segment, region, low - base - begin - k, high - base - begin + k, k)
            if got:
                end = begin + got[1]
                row = (got[0], max(0, end - len(segment)), end)
                if key not in best or row < best[key]:
                    best[key] = row
        for (owner, s), (edits, start, end) in sorted(best.items()):
            yield first + owner, s, start, end, edits

    for number, text in enumerate(texts):
        plain = plain_form(text)
        if block and size + len(plain) > SCAN_CHARS:
            yield from run()
            block, first, size = [], number, 0
        block.append(plain)
        size += len(plain)
    if block:
        yield from run()


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", *,
    edit_rate: float = 0.06, segment_chars: int = 120, block_chars: int = 4_000_000,
) -> DataFrame:
    """One row per (text row, item) with a verified segment or window.

    Columns: doc_id, item_id, segments (how many of the item's segments and
    windows were found), start, end (of the first one, in the plain form), edits
    (their sum; windows overlap, so an edit can count in several).
    Null or empty texts and items match nothing; items whose plain form is
    shorter than 12 characters are too short to tell and match nothing; repeated
    items with one id count as one. A text row that repeats gives its rows again.
    """
    spark = docs.sparkSession
    items = (
        benchmark.where(F.col(text_col).isNotNull() & F.col(item_col).isNotNull())
        .select(F.col(item_col).cast("long").alias("item"), F.col(text_col).alias("text")).distinct()
    )
    # Blocks by a hash of the item; their number follows the benchmark's size, not that of the texts.
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(-(-total // block_chars)) or 1
    plain = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    results = []
    for number in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == number).collect()
        index = build_index(sorted((r["item"], r["text"]) for r in rows), edit_rate, segment_chars)
        held = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("id").to_pylist()
                found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
                for text, segment, start, end, edits in scan(held.value, batch.column("text").to_pylist()):
                    found.setdefault((text, held.value.items[segment]), []).append((start, end, edits))
                keys = sorted(found)
                yield pa.record_batch({
                    "id": pa.array([ids[t] for t, _ in keys], pa.int64()),
                    "item": pa.array([i for _, i in keys], pa.int64()),
                    "segments": pa.array([len(found[k]) for k in keys], pa.int64()),
                    "start": pa.array([min(found[k])[0] for k in keys], pa.int64()),
                    "end": pa.array([min(found[k])[1] for k in keys], pa.int64()),
                    "edits": pa.array([sum(x[2] for x in found[k]) for k in keys], pa.int64()),
                })

        results.append(plain.mapInArrow(run, "id long, item long, segments long, start long, end long, edits long"))
    out = results[0]
    for other in results[1:]:
        out = out.union(other)
    return out.toDF(id_col, item_col, "segments", "start", "end", "edits")


def drop_leaked(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold a benchmark passage; columns and other rows stay.

    The scan marks rows in place, so nothing is shuffled.
    """
    spark = docs.sparkSession
    total, kept = docs, list(docs.columns)
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item"), "text").distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(-(-chars // options.get("block_chars", 4_000_000))) or 1
    schema = docs.schema
    for number in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == number).collect()
        index = build_index(
            sorted((r["item"] or 0, r["text"]) for r in rows), options.get("edit_rate", 0.06), options.get("segment_chars", 120))
        held = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for text, *_ in scan(held.value, batch.column(text_col).to_pylist()):
                    keep[text] = False
                yield batch.filter(pa.array(keep))

        total = total.select(*kept).mapInArrow(run, schema)
    return total
