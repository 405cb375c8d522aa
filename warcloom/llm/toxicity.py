"""Toxic passages as maximal-scoring segments of token log-odds.

1. Token log-odds between toxic and clean labelled texts under an informative
   Dirichlet prior (the pooled token distribution). A token is read as its whole
   word and as its first 3 to 8 letters (written ``^letters``), so inflected
   forms of a stem count together. Tokens whose z-score passes ``z_min`` form
   the lexicon; a word takes the highest score among its readings.
2. Any other word scores the logarithm of how much rarer ordinary words are in a
   toxic passage, of which a share ``density`` are lexicon words; it is below 0.
3. A linear-time scan lists every maximal scoring segment of a text.
   Only lexicon tokens raise the score, so the scan visits those and the gaps
   between them.
4. The chance of a segment of score S in clean text of n tokens follows an
   extreme-value law, E = K n exp(-lambda S). K and lambda are fitted on the
   upper tail of the clean training texts. The significance of all segments is added up and
   mapped to a probability by a monotone calibration on the training texts.

Model size is bounded by ``max_lexicon`` tokens; fitting reads at most
``max_train`` labelled texts (chosen by a hash of the id, among all labels).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SEGMENT = pa.struct([
    ("first_token", pa.int32()), ("last_token", pa.int32()), ("score", pa.float64()), ("e_value", pa.float64()),
])
#: Readings less than e times likelier in toxic texts are left out of the lexicon.
MIN_RATE = 1.0
TOKEN = re.compile(r"[^\W_]+")


class WordScores(dict):
    """Scores of the words met so far; 0 for words outside the lexicon."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon
        self.heads = {k[1:4] for k in lexicon if k[0] == "^"}

    def __missing__(self, word: str) -> float:
        readings = [word]
        if word[:3] in self.heads:
            readings += stems(word)
        if len(self) > 100_000:
            self.clear()
        self[word] = found = max((self.lexicon[r] for r in readings if r in self.lexicon), default=0.0)
        return found


@dataclass
class SegmentModel:
    """Lexicon scores, the score of any other token, and the calibration."""

    scores: dict[str, float]
    other: float
    ev_lambda: float = 1.0
    ev_k: float = 0.1
    knots: list[tuple[float, float]] = field(default_factory=list)

    def __post_init__(self):
        self.words = WordScores(self.scores)

    def __reduce__(self):
        return SegmentModel, (self.scores, self.other, self.ev_lambda, self.ev_k, self.knots)

    def probability(self, evidence: float) -> float:
        """Piecewise-linear through the knots, increasing in the evidence."""
        if not self.knots:
            return 0.0
        if evidence <= self.knots[0][0]:
            return self.knots[0][1]
        for (x0, y0), (x1, y1) in zip(self.knots, self.knots[1:], strict=False):
            if evidence <= x1:
                return y0 + (y1 - y0) * (evidence - x0) / max(x1 - x0, 1e-12)
        return self.knots[-1][1]


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def stems(word: str) -> list[str]:
    return ["^" + word[:k] for k in range(3, min(9, len(word)))]


def maximal_segments(hits: list[tuple[int, float]], other: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, last token, score).

    ``hits`` are the tokens with their own score in order of position; every
    token between them scores ``other`` < 0. Each candidate keeps the running
    total before and after it, and is merged backwards while an earlier one
    starts lower and ends lower; each is merged away at most once.
    """
    stack: list[list] = []  # first, last, total before, total after
    total, previous = 0.0, -1
    for position, score in hits:
        total += other * (position - previous - 1)
        before = total
        total += score
        previous = position
        if score <= 0:
            continue
        first, low = position, before
        while True:
            # Drop back to the nearest candidate that starts lower than this one.
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j -= 1
            if j < 0 or stack[j][3] >= total:
                stack.append([first, position, low, total])
                break
            first, low = stack[j][0], stack[j][2]
            del stack[j:]
    return [(a, b, hi - lo) for a, b, lo, hi in stack]


def segments_of(model: SegmentModel, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
    words = tokens(text)
    hits = [(i, s) for i, s in enumerate(map(model.words.__getitem__, words)) if s]
    return len(words), maximal_segments(hits, model.other) if hits else []


def evidence(model: SegmentModel, n: int, segments: list[tuple[int, int, float]]) -> float:
    """Sum over segments of -ln(E), for those rarer than one expected by chance."""
    base = math.log(max(model.ev_k * max(n, 1), 1e-9))
    return sum(max(0.0, model.ev_lambda * s - base) for _, _, s in segments)


def best_excess(n: int, segments: list[tuple[int, int, float]]) -> float:
    return max((s for _, _, s in segments), default=0.0) - math.log(max(n, 1))


def training_labels(labels: DataFrame, trainable: Column | None, max_train: int) -> DataFrame:
    """(doc_id, toxic) of at most ``max_train`` labelled ids; disagreeing labels go by majority."""
    rows = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    if trainable is not None:
        rows = rows.where(trainable)
    per_id = rows.groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    return per_id.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts that hold each token, by label; added up per task before the shuffle."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def flush() -> pa.RecordBatch:
        words = list(counts[0].keys() | counts[1].keys())
        out = pa.record_batch({
            "word": pa.array(words, pa.string()),
            "clean": pa.array([counts[0][w] for w in words], pa.int64()),
            "toxic": pa.array([counts[1][w] for w in words], pa.int64()),
        })
        counts[0].clear()
        counts[1].clear()
        return out

    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("_toxic").to_pylist(), strict=True):
            words = set(tokens(text))
            counts[toxic].update(words.union(*map(stems, words)))
        if len(counts[0]) + len(counts[1]) > 200_000:
            yield flush()
    yield flush()


def _lexicon(counts: DataFrame, texts: dict[int, int], prior: float, z_min: float, density: float, most: int) -> SegmentModel:
    """Log-odds with the pooled distribution (plus half a text) as Dirichlet prior, in Spark up to the lexicon."""
    n_toxic, n_clean = texts.get(1, 0), texts.get(0, 0)
    if not n_toxic or not n_clean:
        return SegmentModel({}, -0.1)
    alpha = 0.5 + prior * (F.col("toxic") + F.col("clean")) / (n_toxic + n_clean)
    a, b = F.col("toxic") + alpha, F.col("clean") + alpha
    odds = F.log(a / (n_toxic + prior + 1 - F.least(a, F.lit(n_toxic + prior)))) - F.log(
        b / (n_clean + prior + 1 - F.least(b, F.lit(n_clean + prior))))
    rate = F.log(a / (n_toxic + prior)) - F.log(b / (n_clean + prior))
    rows = (
        counts.select("word", rate.alias("rate"), (odds / F.sqrt(1 / a + 1 / b)).alias("z"))
        .where((F.col("z") >= z_min) & (F.col("rate") >= MIN_RATE))
        .orderBy(F.desc("z"), "word")
        .limit(most)
        .collect()  # at most max_lexicon rows
    )
    return SegmentModel({r["word"]: r["rate"] for r in rows}, math.log(1 - density))


def fit(
    docs: DataFrame, labels: DataFrame, trainable: Column | None = None, *, max_train: int = 20_000,
    max_lexicon: int = 5_000, prior: float = 1.0, z_min: float = 3.0, density: float = 0.2,
) -> SegmentModel:
    """Fit on labelled texts. Without labels of both kinds every text scores 0."""
    spark = docs.sparkSession
    chosen = training_labels(labels, trainable, max_train).toDF("_id", "_toxic")
    # At most max_train rows of two numbers, so the broadcast is bounded.
    train = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    counts = (
        train.mapInArrow(_word_counts, "word string, clean long, toxic long")
        .groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    texts = {r["_toxic"]: r["count"] for r in train.groupBy("_toxic").count().collect()}
    model = _lexicon(counts, texts, prior, z_min, density, max_lexicon)
    if not model.scores:
        return model
    held = spark.sparkContext.broadcast(model)

    def binned(batches: Iterator[pa.RecordBatch], model: SegmentModel, measure: Callable) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [math.ceil(4 * measure(*segments_of(model, t))) for t in batch.column("text").to_pylist()]
            yield pa.record_batch({"toxic": batch.column("_toxic"), "bin": pa.array(rows, pa.int32())})

    bins = train.mapInArrow(lambda it: binned(it, held.value, best_excess), "toxic int, bin int").groupBy("toxic", "bin").count().collect()
    model.ev_lambda, model.ev_k = _extreme_value({r["bin"] / 4: r["count"] for r in bins if not r["toxic"]})
    fitted = spark.sparkContext.broadcast(model)

    def strength(n: int, segments: list[tuple[int, int, float]]) -> float:
        return min(evidence(fitted.value, n, segments), 200.0)

    found = train.mapInArrow(
        lambda it: binned(it, fitted.value, strength), "toxic int, bin int").groupBy("bin").agg(
        F.count("*").alias("n"), F.sum("toxic").alias("t")).collect()  # at most 801 bins
    model.knots = _calibrate({r["bin"] / 4: (r["n"], r["t"]) for r in found})
    return model


def _extreme_value(excess: dict[float, int], tail: float = 0.05) -> tuple[float, float]:
    """lambda and K from the upper ``tail`` of clean texts.

    Above a threshold u the excess of S - ln(n) is exponential with rate
    lambda, and K exp(-lambda u) is the share of texts above u. The topmost
    hundredth of the tail is left out, for mislabelled texts.
    """
    n = sum(excess.values())
    above, u, seen = [], 0.0, 0
    for x in sorted(excess, reverse=True):
        if seen >= tail * n:
            break
        above.append((x, excess[x]))
        seen, u = seen + excess[x], x
    kept, left = 0.0, seen // 100
    for x, c in above:
        skip = min(left, c)
        left -= skip
        kept += (x - u) * (c - skip)
    lam = min(1.0, max(0.1, (seen - seen // 100) / kept)) if kept > 0 else 1.0
    return lam, min(1.0, (seen / max(n, 1)) * math.exp(min(lam * u, 0.0)))


def _calibrate(bins: dict[float, tuple[int, int]]) -> list[tuple[float, float]]:
    """Monotone (pool-adjacent) share of toxic texts by evidence, smoothed by one pseudo-text of each kind."""
    blocks: list[list[float]] = []  # x weighted, weight, toxic
    for x in sorted(bins):
        n, t = bins[x]
        blocks.append([x * n, n, t])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][1] >= blocks[-1][2] / blocks[-1][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    knots = [(sx / n, (t + 0.5) / (n + 1)) for sx, n, t in blocks]
    out: list[tuple[float, float]] = []
    for x, y in knots:
        out.append((x, max(y, out[-1][1] if out else 0.0)))
    # Above the last knot the evidence still orders texts, up to 0.999.
    top_x, top_y = out[-1]
    out.append((top_x + 200.0, max(top_y, 0.999)))
    return out


def score(docs: DataFrame, model: SegmentModel, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default doc_id) plus score, predicted, segments of every text.

    ``segments`` lists (first token, last token, score, e_value) of the passages
    rarer than one expected by chance. Null and empty texts have no token, no
    segment and the score of zero evidence. Rows are neither merged nor dropped.
    A kept column with the name of a result is replaced by it.
    """
    keep = [c for c in keep or ["doc_id"] if c not in ("score", "predicted", "segments")]
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept = [docs.schema[c] for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: SegmentModel = held.value
        for batch in batches:
            scores, found = [], []
            for text in batch.column("_toxicity_text").to_pylist():
                n, segments = segments_of(m, text)
                scores.append(m.probability(evidence(m, n, segments)))
                e = [(a, b, s, m.ev_k * max(n, 1) * math.exp(-min(m.ev_lambda * s, 700))) for a, b, s in segments]
                found.append([dict(zip(_SEGMENT.names, x, strict=True)) for x in e if x[3] < 1])
            columns = {c: batch.column(c) for c in keep}
            columns["score"] = pa.array(scores, pa.float64())
            columns["predicted"] = pa.array([int(s >= 0.5) for s in scores], pa.int32())
            columns["segments"] = pa.array(found, pa.list_(_SEGMENT))
            yield pa.record_batch(columns)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    schema = (
        f"{fields}, score double, predicted int, "
        "segments array<struct<first_token:int,last_token:int,score:double,e_value:double>>"
    )
    plain = docs.select(*keep, F.col("text").alias("_toxicity_text"))
    return plain.mapInArrow(run, schema)


def drop_predicted(docs: DataFrame, model: SegmentModel) -> DataFrame:
    """``docs`` without the rows predicted toxic; columns and other rows stay as they are."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: SegmentModel = held.value
        for batch in batches:
            clean = [m.probability(evidence(m, *segments_of(m, t))) < 0.5 for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
