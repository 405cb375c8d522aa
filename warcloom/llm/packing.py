"""Best-fit packing of tokenised documents by minimum bin slack.

A document's ids end with a separator; only documents longer than a sequence
are cut, into full pieces and a shorter last one. Pieces go into sequences as
minimum bin slack prescribes: for each bin, a subset-sum dynamic programme over
the lengths still available, with the reachable sums kept as the bits of one
integer, finds the fullest feasible combination; it is removed, and so on.

Only lengths matter to that choice, and there are at most ``capacity`` of them.
So the programme runs on the histogram of lengths (bounded, whatever the number
of documents), and a combination is removed as many times at once as its
lengths allow. Each removal uses up a length, so there are few distinct
combinations. The longest remaining length is always part of the bin, which
keeps large pieces from being left to the end.

Pieces of one length are interchangeable: the i-th of them takes the i-th place
the plan has for that length. They are numbered by task: counts per task and
length, their running sum, then a number inside the task, so a length that a
third of all pieces share is never gathered.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import cut_lineage
from .word_bpe import WordBpe

CAPACITY = 2048


def fullest(available: dict[int, int], room: int) -> list[int]:
    """Lengths (with repeats) whose sum is the largest that fits into ``room``.

    Bit s of ``reach`` says that sum s is feasible. A length that is available
    n times enters as 1, 2, 4, ... copies, so each step is one shift.
    """
    steps: list[tuple[int, int, int]] = []  # reachable sums before the step, length, copies
    reach, mask = 1, (1 << (room + 1)) - 1
    for length in sorted(available, reverse=True):
        left = min(available[length], room // length)
        copies = 1
        while left > 0:
            take = min(copies, left)
            steps.append((reach, length, take))
            reach |= (reach << (length * take)) & mask
            left -= take
            copies *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    out: list[int] = []
    for before, length, take in reversed(steps):
        if not before >> total & 1:
            out += [length] * take
            total -= length * take
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """(combination of lengths, how many bins hold it) by minimum bin slack."""
    left = {length: n for length, n in histogram.items() if n > 0}
    bins = []
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        if not rest[longest]:
            del rest[longest]
        combination = [longest, *fullest({k: n for k, n in rest.items() if k <= capacity - longest}, capacity - longest)]
        need = Counter(combination)
        times = min(left[k] // n for k, n in need.items())
        bins.append((combination, times))
        for k, n in need.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return bins


@dataclass
class Places:
    """For each length: runs of consecutive places, as arrays sorted by first rank."""

    first: dict[int, np.ndarray]
    base: dict[int, np.ndarray]
    offset: dict[int, np.ndarray]

    def of(self, length: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        run = np.searchsorted(self.first[length], rank, "right") - 1
        return self.base[length][run] + rank - self.first[length][run], self.offset[length][run]


def places(bins: list[tuple[list[int], int]]) -> Places:
    runs: dict[int, list[tuple[int, int, int]]] = {}
    used: Counter = Counter()
    sequence = 0
    for combination, times in bins:
        offset = 0
        for length in combination:
            runs.setdefault(length, []).append((used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    columns = {k: np.array(v, np.int64).T for k, v in runs.items()}
    return Places({k: c[0] for k, c in columns.items()}, {k: c[1] for k, c in columns.items()}, {k: c[2] for k, c in columns.items()})


def _cut(ids: bytes, capacity: int) -> list[tuple[int, int, int]]:
    """(start, length, crc32 of the little-endian ids) of each piece."""
    n = len(ids) // 4
    return [
        (start, min(capacity, n - start), zlib.crc32(ids[4 * start:4 * (start + capacity)]))
        for start in range(0, n, capacity)
    ]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, keep: list[str] | None = None) -> DataFrame:
    """A row per piece: the kept columns, piece, start, length, ids (little-endian), ids_crc32."""
    keep = keep or ["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode: Callable = WordBpe.shared(tokenizer_path).encode
        for batch in batches:
            rows, owner = [], []
            for i, text in enumerate(batch.column("_packing_text").to_pylist()):
                ids = encode(text or "") + b"\0\0\0\0"
                for piece, (start, length, crc) in enumerate(_cut(ids, capacity)):
                    rows.append((piece, start, length, crc, ids[4 * start:4 * (start + length)]))
                    owner.append(i)
            for at in range(0, len(rows), 2000):
                part = rows[at:at + 2000]
                taken = pa.array(owner[at:at + 2000], pa.int64())
                columns = {c: batch.column(c).take(taken) for c in keep}
                for k, (name, kind) in enumerate(_PIECE.items()):
                    columns[name] = pa.array([r[k] for r in part], kind)
                yield pa.record_batch(columns)

    kept = {f.name: f for f in docs.schema.fields}
    schema = ", ".join(f"`{c}` {kept[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, F.col("text").alias("_packing_text")).mapInArrow(
        run, f"{schema}, piece int, start long, length long, ids_crc32 long, ids binary")


_PIECE = {"piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "ids": pa.binary()}


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the task and, for each piece, how many of its length the task saw before."""
    seen: Counter = Counter()
    task = TaskContext.get().partitionId()
    for batch in batches:
        lengths = batch.column("length").to_numpy()
        local = np.empty(len(lengths), np.int64)
        order = np.argsort(lengths, kind="stable")
        edges = np.flatnonzero(np.diff(lengths[order], prepend=-1))
        for lo, hi in zip(edges, np.append(edges[1:], len(order)), strict=True):
            length = int(lengths[order[lo]])
            local[order[lo:hi]] = seen[length] + np.arange(hi - lo)
            seen[length] += int(hi - lo)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(local), task, np.int64)), pa.array(local)],
            [*batch.schema.names, "_task", "_local"])


def assign(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with a ``length`` column of 1 to ``capacity``) plus sequence_id and offset.

    The pieces are checkpointed, so that a lost executor cannot renumber them.
    Sequences are numbered from 0 and filled without gaps. Equal rows take
    different places; an empty table gives no sequence.
    """
    spark = pieces.sparkSession
    held = cut_lineage(pieces)
    tagged = held.mapInArrow(_numbered, StructType([*held.schema.fields]).add("_task", "long").add("_local", "long"))
    counts = cut_lineage(tagged.groupBy("_task", "length").agg(F.count("*").alias("_n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # a row per length
    where = spark.sparkContext.broadcast(places(plan(histogram, capacity)))
    # Where a task's pieces of a length begin: what earlier tasks have. A row per task and length.
    earlier = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("_task", "length", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))
    ranked = tagged.join(first, ["_task", "length"]).select(
        *held.columns, (F.col("_first") + F.col("_local")).alias("_rank"))

    names = list(held.columns)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            edges = np.flatnonzero(np.diff(lengths[order], prepend=-1))
            for lo, hi in zip(edges, np.append(edges[1:], len(order)), strict=True):
                rows = order[lo:hi]
                sequence[rows], offset[rows] = where.value.of(int(lengths[rows[0]]), ranks[rows])
            kept = batch.select(names)
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(sequence), pa.array(offset)], [*kept.schema.names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, StructType([*held.schema.fields]).add("sequence_id", "long").add("offset", "long"))


def pack(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, keep: list[str] | None = None, with_ids: bool = False,
) -> DataFrame:
    """Tokenise and place all rows of ``docs``: the kept columns (default doc_id), piece, start,
    length, ids_crc32, sequence_id, offset, and the ids themselves if asked for.

    Null and empty texts are one piece that holds the separator. Rows are neither merged nor dropped.
    """
    pieces = token_pieces(docs, tokenizer_path, capacity, keep)
    return assign(pieces if with_ids else pieces.drop("ids"), capacity)
