"""Self-join of texts on the Jaccard similarity of their word shingles, by grouped prefixes.

Texts with equal shingle sets form a class. In a fixed order of all shingles
(ordinary ones by hash, then frequent ones by rising frequency) two sets of
sizes n and m and similarity 0.8 share at least a = ceil(4 (n + m) / 9)
shingles, so at least k of their first n - a + k and m - a + k. Prefixes are
long enough for k = 1 + n // 16, which tells near copies from texts that only
share a passage. Classes with identical prefix and size form a group; groups
meet in the posting lists of prefix shingles, group pairs are filtered by size,
position and number of lists, then expanded to their classes, which are
verified on whole sets.

No posting list is multiplied with itself. First each group meets one pivot,
the group in which the shingle comes earliest; whatever that links becomes
one component, and lists that hold a single component are done. Only pairs from
different components are tried after that, so a large family of near copies
costs one comparison per member while no link between components is lost. Lists
that hold the same groups are merged into one with a weight and, for each group,
its earliest place in them, which can only let more pairs through to verification.
A pair is named only where its first common shingle may be, at most n - a places
into one set and m - a into the other; how many lists it shares is then counted on
the lists of the two groups, so pairs that share too few make no row.

Frequent shingles only steer the order, never the result: pairs that share no
more than a common passage then have no prefix shingle in common. They are
counted over all texts; each task reports what at least two of its texts hold.
The table of at most ``_MOST_FREQUENT`` of them (16 bytes each, by falling count)
is broadcast; a frequent shingle beyond it is ordered like any other.

Shingles and sets are named by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import cut_lineage
from .common import mix64
from .components import components
from .shingles import set_name, shingle_sets

#: Shingles a task holds before it reports the frequent ones among them.
_COUNT_BLOCK = 1_000_000
_MOST_FREQUENT = 1_000_000
_BATCH_ROWS = 1_000
_FREQUENT_FROM = 8
#: Bits of a list's weight in its name; the rest is a hash.
_WEIGHT_BITS = 18
#: Bits of the filters that keep shingles and texts without any candidate out of the shuffles.
_FILTER_BITS = 26


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per text (id, size, class), and the locally frequent shingles with their counts."""
    held: list[np.ndarray] = []
    size = 0

    def frequent() -> pa.RecordBatch:
        nonlocal held, size
        values, counts = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64),) * 2
        often = counts >= 2
        held, size = [], 0
        k = int(often.sum())
        return pa.record_batch({
            "id": pa.nulls(k, pa.int64()), "n": pa.nulls(k, pa.int64()), "cls": pa.nulls(k, pa.int64()),
            "shingle": pa.array(values[often].view(np.int64)), "seen": pa.array(counts[often].astype(np.int64)),
        })

    for batch in batches:
        sizes, names = [], []
        for s in shingle_sets(batch.column("text").to_pylist()):
            sizes.append(len(s))
            names.append(set_name(s))
            held.append(s)
            size += len(s)
            if size > _COUNT_BLOCK:
                yield frequent()
        k = len(sizes)
        yield pa.record_batch({
            "id": batch.column("id"), "n": pa.array(sizes, pa.int64()), "cls": pa.array(names, pa.int64()),
            "shingle": pa.nulls(k, pa.int64()), "seen": pa.nulls(k, pa.int64()),
        })
    yield frequent()


class _Order:
    """Prefixes under the global order; ``frequent`` is sorted, ``rank`` orders it by frequency."""

    def __init__(self, shingles: np.ndarray, counts: np.ndarray):
        values = shingles.view(np.uint64)
        by_value = np.argsort(values)
        self.frequent = values[by_value]
        self.rank = np.empty(len(values), np.int64)
        self.rank[np.lexsort((self.frequent, counts[by_value]))] = np.arange(len(values))

    def prefix(self, s: np.ndarray) -> np.ndarray:
        need = len(s) - (4 * len(s) + 4) // 5 + 1 + len(s) // 16
        if not len(self.frequent):
            return s[:need]
        at = np.minimum(np.searchsorted(self.frequent, s), len(self.frequent) - 1)
        often = self.frequent[at] == s
        plain = s[~often][:need]
        if len(plain) == need:
            return plain
        rest = s[often][np.argsort(self.rank[at[often]])]
        return np.concatenate([plain, rest[:need - len(plain)]])


def _group_name(prefix: np.ndarray, n: int) -> int:
    places = np.arange(1, len(prefix) + 1, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB)
    total = mix64(prefix + places).sum(dtype=np.uint64, keepdims=True) + np.uint64(n)
    return int(mix64(total).view(np.int64)[0])


def _postings(batches: Iterator[pa.RecordBatch], order: _Order, wanted: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """A row per prefix shingle that passes the bit filter, if there is one.

    The first row of a text, which no filter removes, also names its class; the others say 0.
    """
    for batch in batches:
        parts, groups, sizes, places, classes, held = [], [], [], [], [], 0

        def out() -> pa.RecordBatch:
            lengths = [len(p) for p in parts]
            return pa.record_batch({
                "shingle": pa.array(np.concatenate(parts).view(np.int64)),
                "grp": pa.array(np.repeat(np.array(groups, np.int64), lengths)),
                "n": pa.array(np.repeat(np.array(sizes, np.int64), lengths)),
                "pos": pa.array(np.concatenate(places)), "cls": pa.array(np.concatenate(classes)),
            })

        for s in shingle_sets(batch.column("text").to_pylist()):
            if not len(s):
                continue
            prefix = order.prefix(s)
            groups.append(_group_name(prefix, len(s)))
            sizes.append(len(s))
            kept = np.arange(len(prefix), dtype=np.int64)
            if wanted is not None:
                passed = _passed(wanted, prefix)
                passed[0] |= passed.any()
                kept = kept[passed]
            prefix = prefix[kept]
            parts.append(prefix)
            places.append(kept)
            names = np.zeros(len(prefix), np.int64)
            names[kept == 0] = set_name(s)
            classes.append(names)
            held += len(prefix)
            if held > 200_000:
                yield out()
                parts, groups, sizes, places, classes, held = [], [], [], [], [], 0
        if parts:
            yield out()


def _members(batches: Iterator[pa.RecordBatch], order: _Order, wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(group, class, size, set) of the texts whose group passes the bit filter."""
    for batch in batches:
        rows: list[tuple] = []
        seen: set[int] = set()
        held = 0

        def out() -> pa.RecordBatch:
            return pa.record_batch({
                "grp": pa.array([r[0] for r in rows], pa.int64()), "cls": pa.array([r[1] for r in rows], pa.int64()),
                "n": pa.array([len(r[2]) for r in rows], pa.int64()), "shingles": pa.array([r[2].tobytes() for r in rows], pa.binary()),
            })

        # Sets leave in pieces of a few megabytes: a batch of long texts has sets larger than itself.
        for start in range(0, batch.num_rows, 1000):
            for s in shingle_sets(batch.column("text").slice(start, 1000).to_pylist()):
                if not len(s):
                    continue
                group = _group_name(order.prefix(s), len(s))
                if not _passed(wanted, np.array([group], np.int64).view(np.uint64))[0]:
                    continue
                name = set_name(s)
                if name not in seen:  # copies within the batch are one class
                    seen.add(name)
                    rows.append((group, name, s))
                    held += len(s)
                    if held > 400_000:
                        yield out()
                        rows, held = [], 0
        if rows:
            yield out()


def _passed(bits: np.ndarray, names: np.ndarray) -> np.ndarray:
    slot = names >> np.uint64(64 - _FILTER_BITS)
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def _bit_filter(names: DataFrame, column: str) -> np.ndarray:
    """Bitmap of 64-bit names, 8 MB whatever their number. False positives only cost work."""
    words = (
        names.select(F.shiftrightunsigned(column, 64 - _FILTER_BITS).alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("bits"))
        .toPandas()  # at most 2^20 rows
    )
    out = np.zeros(1 << (_FILTER_BITS - 6), np.uint64)
    if len(words):
        out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sets reach the similarity, by exact integer arithmetic."""
    for batch in batches:
        keep = []
        for left, right in zip(batch.column("left_set"), batch.column("right_set"), strict=True):
            x, y = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            common = int((y[at] == x).sum())
            keep.append(100 * common >= 80 * (len(x) + len(y) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _verify(pairs: DataFrame, members: DataFrame) -> DataFrame:
    sets = members.select("cls", "shingles")
    wide = (
        pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
        .join(sets.toDF("a", "left_set"), "a").join(sets.toDF("b", "right_set"), "b")
        .select("a", "b", "left_set", "right_set")
    )
    return wide.mapInArrow(_linked, "a long, b long")


def _common(n1: Column, n2: Column) -> Column:
    """How many prefix shingles a pair of these sizes must share."""
    return 1 + F.floor(F.least(n1, n2) / 16)


def _overlap(n1: Column, n2: Column) -> Column:
    """The least number of common shingles at which sets of these sizes link."""
    return F.floor((4 * (n1 + n2) + 8) / 9)


def _passes(n1: Column, p1: Column, n2: Column, p2: Column) -> Column:
    """Size and position filter for two postings of one shingle."""
    needed = _overlap(n1, n2)
    return (5 * F.least(n1, n2) >= 4 * F.greatest(n1, n2)) & (
        F.least(n1 - p1, n2 - p2) > needed - _common(n1, n2))


def _met(left: DataFrame) -> DataFrame:
    """(g, h, n, n2): pairs of groups from different components, by lists that may hold their first common shingle.

    Nothing before that shingle is common, so the place of it leaves room for the whole overlap in both sets.
    """
    right = left.select("same", "grp", "n", "pos", "label").toDF("same", "grp2", "n2", "pos2", "label2")
    n, n2 = F.col("n"), F.col("n2")
    return (
        left.join(right, "same").where("grp < grp2 AND label <> label2")
        .where(5 * F.least(n, n2) >= 4 * F.greatest(n, n2))
        .where(F.least(n - F.col("pos"), n2 - F.col("pos2")) >= _overlap(n, n2))
        .select(F.col("grp").alias("g"), F.col("grp2").alias("h"), "n", "n2")
    )


def _sharing(pairs: DataFrame, left: DataFrame) -> DataFrame:
    """The pairs (g, h) whose lists in common hold as many shingles as their sizes ask for."""
    most = (1 << _WEIGHT_BITS) - 1
    # All groups of a merged list have its weight, so equal lists have equal names.
    name = F.shiftleft(F.xxhash64("same"), _WEIGHT_BITS).bitwiseOR(F.least("weight", F.lit(most)))
    held = left.groupBy("grp").agg(F.collect_set(name).alias("lists"))  # no more than a prefix
    shared = F.aggregate(
        F.array_intersect("lists", "lists2"), F.lit(0).cast("long"), lambda total, x: total + x.bitwiseAND(F.lit(most)))
    return (
        pairs.join(held.toDF("g", "lists"), "g").join(held.toDF("h", "lists2"), "h")
        .where(shared >= F.least(_common(F.col("n"), F.col("n2")), F.lit(most))).select("g", "h")
    )


def _frequent(survey: DataFrame) -> _Order:
    rows = (
        survey.where("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("seen").alias("seen"))
        .where(F.col("seen") >= _FREQUENT_FROM).orderBy(F.desc("seen"), "shingle").limit(_MOST_FREQUENT).toPandas()
    )
    return _Order(rows["shingle"].to_numpy(np.int64), rows["seen"].to_numpy(np.int64))


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Fewer rows per Arrow batch while the stages here run: texts, their sets and copies are held per batch."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= _BATCH_ROWS:
        spark.conf.set(key, str(_BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(texts, links); see :func:`_jaccard_classes`. All stages have run when it returns."""
    with _small_batches(docs.sparkSession):
        return _jaccard_classes(docs, id_col, text_col)


def _jaccard_classes(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(texts, links): a row per text (id, n, cls) and the verified links between classes (a, b).

    The links connect exactly the classes that all links would connect; links
    inside a component found before are not listed. Null, empty and wordless
    texts have n = 0 and take part in no link; equal texts share a class, however
    often rows repeat. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    survey = cut_lineage(plain.mapInArrow(_survey, "id long, n long, cls long, shingle long, seen long"))
    texts = survey.where("n IS NOT NULL").select("id", "n", "cls")
    order = spark.sparkContext.broadcast(_frequent(survey))

    def postings(wanted) -> DataFrame:
        return plain.select("text").mapInArrow(
            lambda it: _postings(it, order.value, wanted.value if wanted else None),
            "shingle long, grp long, n long, pos long, cls long")

    shared = cut_lineage(
        postings(None).groupBy("shingle").agg(F.count("*").alias("_texts")).where("_texts > 1").select("shingle"))
    bits = spark.sparkContext.broadcast(_bit_filter(shared, "shingle"))
    lists = cut_lineage(
        postings(bits).join(shared, "shingle", "left_semi")
        .groupBy("shingle", "grp", "n", "pos").agg(F.min("cls").alias("low"), F.max("cls").alias("high"))
    )
    bits.unpersist()
    several = lists.where("pos = 0 AND low <> high").select("grp").distinct()
    meeting = lists.groupBy("shingle").agg(
        F.min(F.struct("pos", "n", "grp")).alias("pivot"), F.min("grp").alias("first"), F.max("grp").alias("last")
    ).where("first <> last").select("shingle", "pivot")
    # Pairs with a pivot are a choice of what to try first; the rest follows below.
    star = cut_lineage(
        lists.join(meeting, "shingle").where("grp <> pivot.grp")
        .where(_passes(F.col("n"), F.col("pos"), F.col("pivot.n"), F.col("pivot.pos")))
        .groupBy(F.col("grp").alias("g"), F.col("pivot.grp").alias("h"), "n", F.col("pivot.n").alias("m"))
        .agg(F.count("*").alias("lists")).where(F.col("lists") >= _common(F.col("n"), F.col("m"))).select("g", "h")
    )

    def sets_of(groups: DataFrame) -> DataFrame:
        """(group, class, size, set) of every class of the groups, and of a few others that pass the filter."""
        bits = spark.sparkContext.broadcast(_bit_filter(groups, "grp"))
        rows = plain.select("text").mapInArrow(
            lambda it: _members(it, order.value, bits.value), "grp long, cls long, n long, shingles binary")
        found = cut_lineage(rows.dropDuplicates(["cls"]))
        bits.unpersist()
        return found

    members = sets_of(star.select("g").union(star.select("h")).union(several).toDF("grp"))
    heads = members.groupBy("grp").agg(F.min("cls").alias("head"))
    pairs = (
        star.join(heads.toDF("g", "a"), "g").join(heads.toDF("h", "b"), "h").select("a", "b")
        .union(members.join(heads, "grp").where("cls <> head").select(F.col("cls").alias("a"), F.col("head").alias("b")))
    )
    links = cut_lineage(_verify(pairs, members))

    # What is left: pairs from different components, in lists that hold more than one.
    labels = components(links)
    named = (
        members.select("grp", "cls").join(labels.toDF("cls", "label"), "cls", "left")
        .select("grp", F.coalesce("label", "cls").alias("label")).distinct()
    )
    open_lists = lists.join(named, "grp", "left").select("shingle", "grp", "n", "pos", F.coalesce("label", "grp").alias("label"))
    # Lists of the same groups are one list with a weight: texts that share a passage meet once, not once a shingle.
    member = [F.xxhash64("grp", "label"), F.xxhash64("label", "grp")]
    mixed = (
        open_lists.groupBy("shingle")
        .agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("held"),
             *[F.bit_xor(h).alias(f"h{i}") for i, h in enumerate(member)])
        .where("x <> y").select("shingle", F.struct("held", "h0", "h1").alias("same"))
    )
    left = cut_lineage(
        open_lists.join(mixed, "shingle").groupBy("same", "grp", "n", "label")
        .agg(F.min("pos").alias("pos"), F.count("*").alias("weight"))
    )
    tried = (
        star.select(F.least("g", "h").alias("g"), F.greatest("g", "h").alias("h"))
        .join(several.toDF("g"), "g", "left_anti").join(several.toDF("h"), "h", "left_anti").distinct())
    rest = cut_lineage(_sharing(_met(left).distinct().join(tried, ["g", "h"], "left_anti"), left))
    inner = members.join(several, "grp", "left_semi").select("grp", "cls").join(
        labels.toDF("cls", "label"), "cls", "left").select("grp", "cls", F.coalesce("label", "cls").alias("label"))
    within = inner.join(inner.toDF("grp", "cls2", "label2"), "grp").where("cls < cls2 AND label <> label2").select(
        F.col("cls").alias("a"), F.col("cls2").alias("b"))
    more = sets_of(rest.select("g").union(rest.select("h")).union(several).toDF("grp"))
    order.unpersist()
    ids = more.select("grp", "cls")
    across = rest.join(ids.toDF("g", "a"), "g").join(ids.toDF("h", "b"), "h").select("a", "b")
    return texts, cut_lineage(links.union(_verify(across.union(within), more)))


def _named(texts: DataFrame, links: DataFrame) -> DataFrame:
    """(id, n, cls, component) of the texts with words."""
    return texts.where("n > 0").join(components(links).toDF("cls", "component"), "cls", "left").select(
        "id", "n", "cls", F.coalesce("component", "cls").alias("component"))


def near_duplicate_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) per text; component_id is the least id reachable by links.

    Rows are neither merged nor dropped; a null id stays null and never names a
    component unless no member has an id. Texts without words are their own component.
    """
    texts, links = jaccard_classes(docs, id_col, text_col)
    named = _named(texts, links)
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    joined = named.join(least, "component").select("id", "n", "component_id")
    alone = texts.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return joined.union(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with the least id.

    Of rows that repeat with one id and equal sets one stays. Texts without
    words are linked with nothing and all stay. Columns are unchanged; none may
    be named _cls.
    """
    texts, links = jaccard_classes(docs, id_col, text_col)
    named = _named(texts, links)
    best = named.groupBy("component").agg(F.min(F.struct(F.isnull("id").alias("none"), "id", "cls")).alias("best"))
    judged = cut_lineage(
        named.join(best, "component").groupBy("id", "cls")
        .agg(F.count("*").alias("rows"), F.first(F.col("id").eqNullSafe(F.col("best.id")) & (F.col("cls") == F.col("best.cls"))).alias("stays"))
    )
    names = list(docs.columns)

    def name_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes = [set_name(s) if len(s) else None for s in shingle_sets(batch.column(text_col).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(classes, pa.int64())], [*names, "_cls"])

    marked = docs.mapInArrow(name_classes, StructType([*docs.schema.fields]).add("_cls", "long"))

    def matches(rows: DataFrame) -> Column:
        return F.col(id_col).cast("long").eqNullSafe(rows["_id"]) & (F.col("_cls") == rows["_name"])

    gone = judged.where("NOT stays").select(F.col("id").alias("_id"), F.col("cls").alias("_name"))
    kept = marked.join(gone, matches(gone), "left_anti")
    again = judged.where("stays AND rows > 1").select(F.col("id").alias("_id"), F.col("cls").alias("_name"))
    if again.isEmpty():
        return kept.select(*names)
    single = kept.join(again, matches(again), "left_anti").select(*names)
    return single.union(kept.join(again, matches(again), "left_semi").dropDuplicates([id_col, "_cls"]).select(*names))
