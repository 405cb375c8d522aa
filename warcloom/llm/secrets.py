"""Secrets in texts: patterns, and a small character convolutional network over every candidate.

Three patterns give the base findings. Candidates are all of these and every other
run of token characters that is long enough and mixes letters with digits or
case. Each candidate and its surrounding context go through a convolutional network
written in numpy: characters are embedded, convolved, rectified and max-pooled
separately over the candidate and its context, then two dense layers.

The network is trained on all labelled findings: base findings are secrets;
candidates that are none and ordinary long words are not. Half of the training
examples lose their context, so the shape of a candidate counts as well as its
surroundings. Scores are calibrated on held-out findings (Platt), and the
threshold is the highest that keeps ``recall`` of the held-out secrets. Candidates
at or over it are added to the base findings, which always stay.

Findings are dealt by hash into groups of about ``GROUP``, a fifth of them held
out. In each round every group trains on all of its examples from the weights of
the round before, and the mean of their weights, by examples, goes on (federated
averaging). Held-out scores are counted by rounded value, so calibration and
threshold come from all of them and the driver sees a few thousand counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import cut_lineage

# The kinds in the order in which spans that start together are listed, and their patterns.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_DIGIT, _LETTER, _RISE = re.compile("[0-9]"), re.compile("[A-Za-z]"), re.compile("[a-z][A-Z]")
_WORD = re.compile(r"[A-Za-z]{10,}")
BEFORE, AFTER, BODY = 24, 8, 64
GROUP = 16_384
_SCALE, _REACH = 64, 32  # held-out scores are counted in steps of 1/64 from -32 to 32
_ALPHABET = 98  # padding, printable ASCII, white space, anything else


def base_findings(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, stop), leftmost and non-overlapping per kind, by start, then kind.

    A run of 24 or more hexadecimal characters is the whole of the run: a leftmost
    match starts where the run starts.
    """
    found = []
    lowered = text.lower()
    if any(w in lowered for w in _WORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str) -> list[tuple[int, int]]:
    """Runs of token characters that mix letters with digits, or rise from small to capital three times."""
    return [
        m.span() for m in _CANDIDATE.finditer(text)
        if _LETTER.search(m[0]) and (_DIGIT.search(m[0]) or len(_RISE.findall(m[0])) >= 3)
    ]


def apart(spans: list[tuple[int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans that touch none of the taken ones; both in order of start. One pass over each."""
    out, i, reach = [], 0, 0
    for start, stop in spans:
        while i < len(taken) and taken[i][0] < stop:
            reach = max(reach, taken[i][1])
            i += 1
        if reach <= start:
            out.append((start, stop))
    return out


def _codes(text: str) -> list[int]:
    return [ord(c) - 30 if " " < c < "\x7f" else (1 if c.isspace() else 97) for c in text]


def encode(text: str, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
    """Character codes of the context and of the candidate, in windows of ``BODY`` if it is longer."""
    left = _codes(text[max(0, start - BEFORE):start])
    right = _codes(text[stop:stop + AFTER])
    context = np.array([0] * (BEFORE - len(left)) + left + right + [0] * (AFTER - len(right)), np.int64)
    body = _codes(text[start:stop])
    pieces = [body[i:i + BODY] for i in range(0, max(len(body), 1), BODY)]
    if len(pieces) > 1 and len(pieces[-1]) < BODY:
        pieces[-1] = body[-BODY:]
    windows = np.array([p + [0] * (BODY - len(p)) for p in pieces], np.int64)
    return context, windows


@dataclass
class CharCnn:
    """Weights, calibration and threshold."""

    weights: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5

    @staticmethod
    def fresh(rng: np.random.Generator, embed: int = 8, width: int = 4, filters: int = 16, hidden: int = 16) -> CharCnn:
        def normal(*shape: int, fan: int) -> np.ndarray:
            return rng.normal(0, np.sqrt(2 / fan), shape)

        return CharCnn({
            "embed": normal(_ALPHABET, embed, fan=embed), "body": normal(width * embed, filters, fan=width * embed),
            "body_bias": np.zeros(filters), "context": normal(width * embed, filters, fan=width * embed),
            "context_bias": np.zeros(filters), "dense": normal(2 * filters, hidden, fan=2 * filters),
            "dense_bias": np.zeros(hidden), "out": normal(hidden, 1, fan=hidden), "out_bias": np.zeros(1),
        })

    def _pool(self, codes: np.ndarray, part: str) -> tuple[np.ndarray, tuple]:
        w = self.weights
        width = w[part].shape[0] // w["embed"].shape[1]
        places = np.arange(codes.shape[1] - width + 1)[:, None] + np.arange(width)
        grams = codes[:, places]
        flat = w["embed"][grams].reshape(len(codes), len(places), -1)
        maps = flat @ w[part] + w[part + "_bias"]
        best = maps.argmax(axis=1)
        pooled = np.maximum(np.take_along_axis(maps, best[:, None, :], 1)[:, 0, :], 0)
        return pooled, (grams, flat, best, pooled)

    def _forward(self, contexts: np.ndarray, bodies: np.ndarray) -> tuple[np.ndarray, tuple]:
        w = self.weights
        a, seen_a = self._pool(bodies, "body")
        b, seen_b = self._pool(contexts, "context")
        joined = np.concatenate([a, b], axis=1)
        hidden = np.maximum(joined @ w["dense"] + w["dense_bias"], 0)
        return (hidden @ w["out"] + w["out_bias"])[:, 0], (seen_a, seen_b, joined, hidden)

    def raw(self, contexts: np.ndarray, bodies: np.ndarray) -> np.ndarray:
        return self._forward(contexts, bodies)[0]

    def gradients(self, contexts: np.ndarray, bodies: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss."""
        w = self.weights
        score, (seen_a, seen_b, joined, hidden) = self._forward(contexts, bodies)
        error = ((1 / (1 + np.exp(-score))) - labels)[:, None] / len(labels)
        grads = {"out": hidden.T @ error, "out_bias": error.sum(0), "embed": np.zeros_like(w["embed"])}
        back = (error @ w["out"].T) * (hidden > 0)
        grads["dense"], grads["dense_bias"] = joined.T @ back, back.sum(0)
        back = back @ w["dense"].T
        filters = w["body"].shape[1]
        for part, (grams, flat, best, pooled), g in (("body", seen_a, back[:, :filters]), ("context", seen_b, back[:, filters:])):
            g = g * (pooled > 0)
            rows = np.arange(len(g))[:, None]
            chosen = flat[rows, best]  # example, filter, gram values
            grads[part] = np.einsum("nfd,nf->df", chosen, g)
            grads[part + "_bias"] = g.sum(0)
            values = np.einsum("nf,df->nfd", g, w[part]).reshape(*g.shape, grams.shape[2], -1)
            np.add.at(grads["embed"], grams[rows, best], values)
        return grads

    def probability(self, contexts: np.ndarray, bodies: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.raw(contexts, bodies) + self.shift)))

    def judge(self, text: str, spans: list[tuple[int, int]]) -> np.ndarray:
        """Calibrated probability of each span; a long candidate takes its likeliest window."""
        if not spans:
            return np.zeros(0)
        contexts, bodies, owner = [], [], []
        for i, (start, stop) in enumerate(spans):
            context, windows = encode(text, start, stop)
            contexts += [context] * len(windows)
            bodies.append(windows)
            owner += [i] * len(windows)
        out = np.zeros(len(spans))
        flat, owners = np.concatenate(bodies), np.array(owner)
        all_contexts = np.array(contexts)
        for at in range(0, len(flat), 512):  # bounds memory on texts full of candidates
            np.maximum.at(out, owners[at:at + 512], self.probability(all_contexts[at:at + 512], flat[at:at + 512]))
        return out


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, text, start, stop): the finding and its context, as a text of its own."""
    for batch in batches:
        rows: list[tuple[int, str, int, int]] = []
        for text in batch.column("text").to_pylist():
            if not text:
                continue
            base = base_findings(text)
            taken = []
            for kind, start, stop in base:
                if kind == "assign":  # the value is the candidate, its keyword the context
                    start = _ASSIGN.match(text, start).start(1)
                taken.append((1, start, stop))
            taken += [(0, start, stop) for start, stop in apart(candidates(text), [(s, e) for _, s, e in base])]
            word = _WORD.search(text, len(text) // 2)
            if word:
                taken.append((0, *word.span()))
            for label, start, stop in taken:
                first = max(0, start - BEFORE)
                rows.append((label, text[first:min(stop, start + 4 * BODY) + AFTER], start - first, min(stop, start + 4 * BODY) - first))
        yield pa.record_batch({
            "label": pa.array([r[0] for r in rows], pa.int32()), "text": pa.array([r[1] for r in rows], pa.string()),
            "start": pa.array([r[2] for r in rows], pa.int32()), "stop": pa.array([r[3] for r in rows], pa.int32())})


def _arrays(texts: list[str], starts: list[int], stops: list[int]) -> tuple[np.ndarray, np.ndarray]:
    encoded = [encode(*example) for example in zip(texts, starts, stops, strict=True)]
    return np.array([c for c, _ in encoded]), np.array([w[0] for _, w in encoded])


def train_epoch(model: CharCnn, contexts: np.ndarray, bodies: np.ndarray, y: np.ndarray, seed: int, rate: float = 0.004, size: int = 64) -> None:
    """One pass of Adam over all examples. Batches hold both labels in equal parts:
    those of the commoner label come once, those of the rarer one as often as needed."""
    rng = np.random.default_rng(seed)
    parts = [rng.permutation(np.flatnonzero(y == label)) for label in (0, 1)]
    longest = max(map(len, parts))
    order = np.stack([np.resize(p, longest) for p in parts if len(p)], axis=1).reshape(-1)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.weights.items()}
    for step, at in enumerate(range(0, len(order), size), 1):
        pick = order[at:at + size]
        seen = contexts[pick] * (rng.random(len(pick)) < 0.5)[:, None]
        for k, g in model.gradients(seen, bodies[pick], y[pick]).items():
            m, v = moments[k]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            model.weights[k] -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)


def _train_group(weights: dict[str, np.ndarray], epochs: int, seed: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("text", "ascending"), ("start", "ascending"), ("stop", "ascending"), ("label", "ascending")])
        contexts, bodies = _arrays(*(rows.column(c).to_pylist() for c in ("text", "start", "stop")))
        y = np.array(rows.column("label").to_pylist(), float)
        model = CharCnn({k: v.copy() for k, v in weights.items()})
        for epoch in range(epochs):
            train_epoch(model, contexts, bodies, y, hash((seed, epoch, key[0].as_py())) & 0xFFFFFFFF)
        flat = np.concatenate([model.weights[k].reshape(-1) for k in sorted(weights)])
        return pa.table({"place": pa.array(range(len(flat)), pa.int32()), "total": flat * len(y), "n": pa.array([len(y)] * len(flat), pa.int64())})

    return run


def _averaged(groups: DataFrame, weights: dict[str, np.ndarray], epochs: int, seed: int) -> dict[str, np.ndarray]:
    """The mean weights of all groups after ``epochs`` passes from ``weights``; a row per weight comes back."""
    sums = groups.groupBy("shard").applyInArrow(_train_group(weights, epochs, seed), "place int, total double, n long")
    rows = sums.groupBy("place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
    flat = np.zeros(len(rows))
    for r in rows:
        flat[r.place] = r.total / r.n
    out, at = {}, 0
    for k in sorted(weights):
        out[k] = flat[at:at + weights[k].size].reshape(weights[k].shape)
        at += weights[k].size
    return out


def _scored(model: CharCnn):
    """(label, score, n): counts of rounded scores, each example with and without its context."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            contexts, bodies = _arrays(*(batch.column(c).to_pylist() for c in ("text", "start", "stop")))
            y = np.array(batch.column("label").to_pylist(), np.int64)
            cells: dict[tuple[int, int], int] = {}
            for at in range(0, len(y), 512):
                part = slice(at, at + 512)
                for seen in (contexts[part], np.zeros_like(contexts[part])):
                    raw = np.clip(np.rint(model.raw(seen, bodies[part]) * _SCALE), -_REACH * _SCALE, _REACH * _SCALE).astype(int)
                    for cell in zip(y[part].tolist(), raw.tolist(), strict=True):
                        cells[cell] = cells.get(cell, 0) + 1
            yield pa.record_batch({
                "label": pa.array([c[0] for c in cells], pa.int32()), "score": pa.array([c[1] for c in cells], pa.int32()),
                "n": pa.array(list(cells.values()), pa.int64())})

    return run


def _platt(raw: np.ndarray, labels: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Logistic calibration with smoothed targets, by Newton steps; each score counts ``n`` times."""
    ones = (labels * n).sum()
    zeros = n.sum() - ones
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    w = np.array([1.0, 0.0])
    x = np.stack([raw, np.ones_like(raw)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(hessian, x.T @ (n * (p - target)) + 1e-3 * (w - np.array([1.0, 0.0])))
        w = w - np.clip(move, -1, 1)
        if np.abs(move).max() < 1e-6:
            break
    return float(max(w[0], 1e-3)), float(w[1])


def fit(docs: DataFrame, text_col: str = "text", recall: float = 0.98, rounds: int = 2, seed: int = 3) -> CharCnn | None:
    """Train on all labelled findings of ``docs``; None if it holds no finding, nothing else or under 20."""
    found = docs.select(F.col(text_col).alias("text")).mapInArrow(_examples, "label int, text string, start int, stop int").distinct()
    place = F.xxhash64("text", "start", "stop")
    found = cut_lineage(found.withColumn("held", F.pmod(place, F.lit(5)) == 0))
    counts = {(r.label, r.held): r["count"] for r in found.groupBy("label", "held").count().collect()}
    total = [counts.get((label, False), 0) + counts.get((label, True), 0) for label in (0, 1)]
    if not all(total) or sum(total) < 20:
        return None
    parts = [counts.get((label, held), 0) for label in (0, 1) for held in (False, True)]
    if not all(parts):  # too few to part: all train, all calibrate
        learn, held = found, found
    else:
        learn, held = found.where("NOT held"), found.where("held")
    learned = sum(total) if learn is found else parts[0] + parts[2]
    shards = -(-learned // GROUP)
    groups = learn.withColumn("shard", F.pmod(F.xxhash64("text", "start", "stop", F.lit(1)), F.lit(shards)))
    model = CharCnn.fresh(np.random.default_rng(seed))
    # Few examples are gone over more often, as in twelve passes over four thousand.
    epochs = max(1, min(6, -(-49_152 // (2 * learned))))
    for number in range(rounds):
        model.weights = _averaged(groups, model.weights, epochs, seed + number)
    rows = held.select("label", "text", "start", "stop").mapInArrow(_scored(model), "label int, score int, n long").groupBy("label", "score").agg(F.sum("n").alias("n")).collect()
    score, label, n = (np.array([r[i] for r in sorted((r.score, r.label, r.n) for r in rows)], float) for i in range(3))
    model.slope, model.shift = _platt(score / _SCALE, label, n)
    # The highest threshold that keeps the asked recall, but never under one half.
    sure, upto = score[label == 1], np.cumsum(n[label == 1])
    lowest = sure[np.searchsorted(upto, int((1 - recall) * upto[-1]), side="right")] / _SCALE
    model.threshold = max(0.5, float(1 / (1 + np.exp(-(model.slope * (lowest - 0.5 / _SCALE) + model.shift)))))
    return model


def scan(docs: DataFrame, model: CharCnn | None, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``base`` and ``added``, spans (kind, start, stop, score) in code points.

    Added spans have the kind ``learned`` and do not touch a base one. Null text
    counts as empty. Without a model nothing is added and scores are null. Rows
    stay as they are; input columns named base or added are replaced.
    """
    docs = docs.drop("base", "added")
    names = list(docs.columns)
    held = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: CharCnn | None = held.value
        for batch in batches:
            base_rows, added_rows = [], []
            for text in batch.column("_scanned").to_pylist():
                text = text or ""
                base = base_findings(text)
                others = apart(candidates(text), [(s, e) for _, s, e in base]) if m else []
                spans = [(s, e) for _, s, e in base] + others
                scores = m.judge(text, spans) if m and spans else [None] * len(spans)
                base_rows.append([
                    {"kind": k, "start": s, "stop": e, "score": p} for (k, s, e), p in zip(base, scores, strict=False)])
                added_rows.append([
                    {"kind": "learned", "start": s, "stop": e, "score": p}
                    for (s, e), p in zip(others, scores[len(base):], strict=True) if p >= m.threshold])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(base_rows, pa.list_(span)), pa.array(added_rows, pa.list_(span))],
                [*names, "base", "added"])

    kind = "array<struct<kind:string,start:bigint,stop:bigint,score:double>>"
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(f"base {kind}, added {kind}").fields])
    return docs.withColumn("_scanned", F.col(text_col)).mapInArrow(run, schema)
