"""Vector code compression: product codes whose codebooks are fitted by cover-tree Lloyd rounds.

Vectors become integers and are cut into equal parts; each part position has a
codebook. Blocks of rows stay where Spark read them. In a block each part position
gets a cover tree: a node's points lie within its radius of its pivot, and its
children's pivots are picked farthest first until every point is within half the
radius of one (or there are ``_WIDEST`` children, whose true radii are kept).
Points are stored in tree order with cumulative sums, so a subtree is a range
whose sum is one subtraction.

A round assigns from the roots down. If a pivot's nearest entry is closer than the
second nearest by more than twice the radius, the triangle inequality gives every
point below to that entry, whole. Only ambiguous nodes descend, and only the
points of ambiguous leaves are compared with all entries. Blocks send one sum per
entry and component; the driver sees the codebooks alone (entries times width).
Distances are exact integers; float roots decide only where the gap is clear.

Defined cases: rows whose vector is null or holds null or non-finite components
take no part. Shorter vectors are padded with zeros to the common width, the
longest length rounded up to a multiple of the parts. A codebook starts from the
smallest ids, null ids last, equal ids by vector; with fewer rows it has fewer
entries. Repeated rows count each time. Components of 2 ** 29 or more after
scaling are refused with an error, as their squares would not fit in 64 bits.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructType

from ..session import cut_lineage
from .topk_products import quantised

_LEAF = 16
_WIDEST = 32
_LARGEST = 1 << 29
_TREE = ("order", "part", "low", "high", "pivot", "radius", "first", "last")


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    n = high - low
    return np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))


@dataclass
class Tree:
    """Cover trees of all part positions of a block; points are numbered part by part.

    ``order`` lists points in tree order; node i holds ``order[low[i]:high[i]]``, and
    its children are the nodes from ``first[i]`` to ``last[i]`` (none for a leaf).
    The first nodes are the roots, one per part.
    """

    order: np.ndarray
    part: np.ndarray
    low: np.ndarray
    high: np.ndarray
    pivot: np.ndarray
    radius: np.ndarray
    first: np.ndarray
    last: np.ndarray


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return (d * d).sum(axis=-1)


def build(points: np.ndarray, parts: int) -> Tree:
    """Trees over ``points`` (parts times rows, components), level by level for all nodes at once."""
    rows = len(points) // parts
    order = np.arange(len(points))
    part, low = np.arange(parts), np.arange(parts) * rows
    high, pivot = low + rows, low.copy()
    reach = np.maximum.reduceat(_squares(points, points[np.repeat(pivot, rows)]), low)
    levels = {name: [] for name in _TREE[1:]}
    made = parts
    while len(part):
        split = np.flatnonzero((high - low > _LEAF) & (reach > 0))
        first = np.zeros(len(part), np.int64)
        last = np.zeros(len(part), np.int64)
        children = _split(points, order, low[split], high[split], pivot[split], reach[split])
        counts = np.bincount(children[0], minlength=len(split))
        first[split] = made + np.cumsum(counts) - counts
        last[split] = made + np.cumsum(counts)
        for name, value in zip(_TREE[1:], (part, low, high, pivot, np.sqrt(reach.astype(np.float64)), first, last), strict=True):
            levels[name].append(value)
        made += int(counts.sum())
        owner, low, high, pivot, reach = children
        part = part[split][owner]
    return Tree(order, *(np.concatenate(levels[name]) for name in _TREE[1:]))


def _split(points: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, pivot: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, ...]:
    """Children of some nodes: (parent, low, high, pivot, squared radius); reorders ``order`` inside the nodes."""
    if not len(low):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    slots, size = _ranges(low, high), high - low
    node = np.repeat(np.arange(len(low)), size)
    here = points[order[slots]]
    best = _squares(here, points[pivot][node])
    own = np.zeros(len(slots), np.int64)
    picked = [(np.arange(len(low)), np.zeros(len(low), np.int64), pivot)]
    active, number = np.arange(len(slots)), 0
    while len(active) and number + 1 < _WIDEST:
        number += 1
        start = np.flatnonzero(np.diff(node[active], prepend=-1))
        most = np.maximum.reduceat(best[active], start)
        owner = node[active][start]
        # 4 d^2 > r^2: some point is farther than half the radius from every child's pivot.
        wide = np.flatnonzero(4 * most > reach[owner])
        is_open = np.zeros(len(low), bool)
        is_open[owner[wide]] = True
        peak = np.zeros(len(low), best.dtype)
        peak[owner] = most
        active = active[is_open[node[active]]]
        if not len(active):
            break
        top = np.flatnonzero(best[active] == peak[node[active]])
        chosen = top[np.diff(node[active][top], prepend=-1) > 0]
        new = order[slots[active[chosen]]]
        picked.append((node[active[chosen]], np.full(len(chosen), number), new))
        at = np.zeros(len(low), np.int64)
        at[node[active[chosen]]] = new
        d = _squares(here[active], points[at[node[active]]])
        nearer = d < best[active]
        best[active[nearer]] = d[nearer]
        own[active[nearer]] = number
    ranked = np.lexsort((own, node))
    order[slots] = order[slots[ranked]]
    start = np.flatnonzero((np.diff(node[ranked], prepend=-1) > 0) | (np.diff(own[ranked], prepend=-1) != 0))
    stop = np.append(start[1:], len(ranked))
    owner, which = node[ranked][start], own[ranked][start]
    known = np.concatenate([o * _WIDEST + k for o, k, _ in picked])
    pivots = np.concatenate([p for _, _, p in picked])
    by = np.argsort(known)
    found = pivots[by][np.searchsorted(known[by], owner * _WIDEST + which)]
    return owner, slots[start], slots[stop - 1] + 1, found, np.maximum.reduceat(best[ranked], start)


def _distances(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances, all points with all entries of one codebook."""
    width = points.shape[1]
    largest = max(int(np.abs(points).max(initial=0)), int(np.abs(book).max(initial=0)), 1)
    if 4 * width * largest * largest < 1 << 53:
        # Whole numbers below 2 ** 53 are exact in floats, whatever the order of the sums.
        p, b = points.astype(np.float64), book.astype(np.float64)
        return ((p * p).sum(axis=1)[:, None] - 2.0 * (p @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    return np.stack([_squares(points, entry) for entry in book], axis=1)


def assign(tree: Tree, points: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(entry of each point, sums, counts, compared): ``books`` is (parts, entries, components).

    Sums and counts are per part and entry; whole subtrees add theirs from cumulative
    sums. ``compared`` is how many points were compared one by one.
    """
    parts, entries, width = books.shape
    ordered = points[tree.order]
    running = np.concatenate([np.zeros((1, width), np.int64), np.cumsum(ordered, axis=0)])
    placed = np.zeros(len(points), np.int64)
    sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
    compared = 0
    level = np.arange(parts) if len(points) else np.zeros(0, np.int64)
    while len(level):
        below = []
        for p in np.unique(tree.part[level]).tolist():
            nodes = level[tree.part[level] == p]
            d = _distances(points[tree.pivot[nodes]], books[p])
            near = d.argmin(axis=1)
            least = d[np.arange(len(nodes)), near]
            d[np.arange(len(nodes)), near] = np.iinfo(np.int64).max
            gap = np.sqrt(d.min(axis=1).astype(np.float64)) - np.sqrt(least.astype(np.float64))
            radius = tree.radius[nodes]
            sure = (gap > 2 * radius * (1 + 1e-9) + 1e-6) | (radius == 0)
            whole, low, high = near[sure], tree.low[nodes[sure]], tree.high[nodes[sure]]
            placed[_ranges(low, high)] = np.repeat(whole, high - low)
            np.add.at(sums[p], whole, running[high] - running[low])
            np.add.at(counts[p], whole, high - low)
            unsure = nodes[~sure]
            leaf = tree.first[unsure] == tree.last[unsure]
            slots = _ranges(tree.low[unsure[leaf]], tree.high[unsure[leaf]])
            if len(slots):
                one = _distances(ordered[slots], books[p]).argmin(axis=1)
                placed[slots] = one
                np.add.at(sums[p], one, ordered[slots])
                counts[p] += np.bincount(one, minlength=entries)
                compared += len(slots)
            inner = unsure[~leaf]
            below.append(_ranges(tree.first[inner], tree.last[inner]))
        level = np.concatenate(below)
    out = np.empty(len(points), np.int64)
    out[tree.order] = placed
    return out, sums, counts, compared


def _cut(vectors: np.ndarray, parts: int) -> np.ndarray:
    """(rows, width) as points: all rows' first parts, then all second parts and so on."""
    rows, width = vectors.shape
    return vectors.reshape(rows, parts, width // parts).transpose(1, 0, 2).reshape(rows * parts, width // parts)


def _plant(batches: Iterator[pa.RecordBatch], parts: int, width: int, block_rows: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """A row per block: ids, labels, vectors and their trees."""
    for batch in batches:
        for start in range(0, batch.num_rows, block_rows):
            block = batch.slice(start, block_rows)
            rows = block.num_rows
            cells = block.column("vec")
            lengths = np.diff(cells.offsets.to_numpy())
            vectors = np.zeros((rows, width), np.int64)
            vectors[np.arange(width) < lengths[:, None]] = cells.flatten().to_numpy()
            tree = build(_cut(vectors, parts), parts)
            row = {"id": [block.column("id").to_pylist()], "label": [block.column("label").to_pylist()], "vectors": [vectors.astype(np.int32).tobytes()]}
            row |= {name: [getattr(tree, name).astype(np.float64 if name == "radius" else np.int32).tobytes()] for name in _TREE}
            yield pa.record_batch([pa.array(row[f.name], f.type) for f in schema], schema=schema)


def _planted(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, Tree, int]]:
    for i in range(batch.num_rows):
        def read(name: str, kind: type = np.int32, i: int = i) -> np.ndarray:
            return np.frombuffer(batch.column(name)[i].as_buffer(), kind).astype(np.float64 if kind is np.float64 else np.int64)

        yield read("vectors").reshape(-1, width), Tree(*(read(n, np.float64 if n == "radius" else np.int32) for n in _TREE)), i


def _round(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """One Lloyd round: the codebooks after assigning every part to its nearest entry."""
    parts, entries, width = books.shape

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for vectors, tree, _ in _planted(batch, parts * width):
                _, s, c, _ = assign(tree, _cut(vectors, parts), books)
                sums += s
                counts += c
        p, e = np.nonzero(counts)
        axis = np.tile(np.arange(width), len(p))
        p, e = np.repeat(p, width), np.repeat(e, width)
        yield pa.record_batch({
            "part": pa.array(p, pa.int32()), "entry": pa.array(e, pa.int32()), "axis": pa.array(axis, pa.int32()),
            "total": pa.array(sums[p, e, axis]), "n": pa.array(counts[p, e]),
        })

    sent = blocks.mapInArrow(gather, "part int, entry int, axis int, total long, n long")
    new = books.copy()
    for r in sent.groupBy("part", "entry", "axis").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        new[r.part, r.entry, r.axis] = r.total // r.n
    return new


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", *,
    parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256, block_rows: int = 4096,
) -> tuple[DataFrame, np.ndarray]:
    """(codes, codebooks): rows (id, label, code binary, error) and the final (parts, entries, components).

    ``code`` has one byte per part, the index of its entry; ``error`` is the squared
    distance to the entries, summed over the parts. At most 256 entries.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte per part: entries must be 1 to 256")
    vec = quantised(F.col(vector_col), scale)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), vec.alias("vec")).where("vec IS NOT NULL")
    rows = rows.withColumn("vec", F.when(
        F.exists("vec", lambda x: F.abs(x) >= _LARGEST), F.raise_error(F.lit(f"a component is {_LARGEST} or more after scaling"))).otherwise(F.col("vec")))
    out = StructType().add("id", rows.schema["id"].dataType).add("label", rows.schema["label"].dataType)
    out = out.add("code", BinaryType()).add("error", LongType())
    longest = rows.agg(F.max(F.size("vec"))).first()[0]
    if longest is None:
        return vectors.sparkSession.createDataFrame([], out), np.zeros((parts, 0, 1), np.int64)
    width = max(1, -(-longest // parts)) * parts
    starts = [r.vec for r in rows.orderBy(F.asc_nulls_last("id"), "vec").limit(entries).select("vec").collect()]
    books = np.array([v + [0] * (width - len(v)) for v in starts], np.int64).reshape(len(starts), parts, -1).transpose(1, 0, 2).copy()

    stored = StructType().add("id", ArrayType(rows.schema["id"].dataType)).add("label", ArrayType(rows.schema["label"].dataType))
    for name in ("vectors", *_TREE):
        stored = stored.add(name, BinaryType())
    planted = _arrow_schema(stored)
    blocks = cut_lineage(rows.mapInArrow(lambda it: _plant(it, parts, width, block_rows, planted), stored))
    for _ in range(rounds):
        books = _round(blocks, books)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows_, tree, i in _planted(batch, width):
                points = _cut(rows_, parts)
                codes = assign(tree, points, books)[0].reshape(parts, len(rows_))
                error = sum(_squares(points.reshape(parts, len(rows_), -1)[p], books[p, codes[p]]) for p in range(parts))
                packed = np.ascontiguousarray(codes.T).astype(np.uint8).tobytes()
                yield pa.record_batch({
                    "id": batch.column("id")[i].values, "label": batch.column("label")[i].values,
                    "code": pa.array([packed[k:k + parts] for k in range(0, len(packed), parts)], pa.binary()), "error": pa.array(error, pa.int64()),
                })

    return cut_lineage(blocks.mapInArrow(encode, out)), books


def _arrow_schema(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def with_label_error(codes: DataFrame) -> DataFrame:
    """Adds ``label_error``: the error summed over rows of equal label, nulls together."""
    totals = codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return codes.join(totals, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
