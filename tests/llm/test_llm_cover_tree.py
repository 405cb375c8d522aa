import numpy as np
import pytest
from llm_frames import SF
from oracle_check import compare, connect

from warcloom.llm import catalogue
from warcloom.llm import cover_tree as T


def brute(rows, parts=16, entries=64, rounds=2):
    """Rows are (id, vector, label)."""
    kept = [(i, [int(np.floor(256 * float(x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    if not kept:
        return [], []
    width = max(1, -(-max(len(v) for _, v, _ in kept) // parts))
    kept = [(i, v + [0] * (width * parts - len(v)), label) for i, v, label in kept]
    cut = [[tuple(v[p * width:(p + 1) * width]) for p in range(parts)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[cut[k][p] for k in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for c in cut:
                members.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            for e, m in members.items():
                books[p][e] = tuple(sum(axis) // len(m) for axis in zip(*m, strict=True))
    out = []
    for (i, _, label), c in zip(kept, cut, strict=True):
        best = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((i, label, bytes(e for _, e in best), sum(d for d, _ in best)))
    return out, books


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], "vec_id long, embedding array<double>, label int, code string, error int")
    codes, books = T.compress(df, **options)
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or 0, r[2], r[3])
    return sorted(((r.id, r.label, bytes(r.code), r.error) for r in codes.collect()), key=key), books.tolist(), key


def same(spark, rows, parts=16, entries=64, rounds=2, **options):
    got, books, key = run(spark, rows, parts=parts, entries=entries, rounds=rounds, **options)
    want, want_books = brute(rows, parts, entries, rounds)
    assert got == sorted(want, key=key)
    assert books == [[list(c) for c in book] for book in want_books]


def test_table_equals_sql(spark):
    assert compare(spark, connect(SF), SF, catalogue.QUERIES["op12_vector_codes"], catalogue.ORACLES["op12_vector_codes"]) is None


def test_awkward_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=6) * (3 if i % 5 else 0.1)).tolist(), i % 3) for i in range(300)]
    rows += [(400 + i, [0.5] * 6, None) for i in range(150)]  # one very common vector
    rows += [(7, [0.25] * 6, 1), (7, [0.25] * 6, 1), (None, [1.0] * 6, 2), (900, None, 1), (901, [1.0, None], 1), (902, [float("nan")] * 6, 1),
             (903, [float("-inf")] * 6, 1), (904, [], 4), (905, [2.0], None), (906, [1000.0] * 6, 5), (-1, [-0.001] * 6, 0)]
    same(spark, rows, parts=3, entries=10, block_rows=64)
    same(spark, rows, parts=4, entries=256, rounds=3)  # padded to eight components; every row an entry at first


def test_few_rows_and_none(spark):
    same(spark, [(3, [1.0, 2.0], 1), (1, [1.0, 2.0], None)])
    same(spark, [(None, [1.0, 2.0], 1)])
    assert run(spark, [])[0] == [] and run(spark, [(1, None, 1)])[0] == []


def test_label_error(spark):
    df = spark.createDataFrame([(1, None, b"a", 2), (2, None, b"a", 3), (3, 1, b"b", 4)], "id long, label int, code binary, error long")
    assert sorted((r.id, r.label_error) for r in T.with_label_error(df).collect()) == [(1, 5), (2, 5), (3, 4)]


def test_components_too_large_for_exact_squares_are_refused(spark):
    with pytest.raises(Exception, match="after scaling"):
        run(spark, [(1, [3e6], 1)])


@pytest.mark.parametrize("spread", [1, 40, 100_000_000])
def test_trees_and_assignment(spread):
    rng = np.random.default_rng(spread)
    parts, rows = 3, 700
    points = T._cut(np.floor(rng.normal(size=(rows, 6)) * spread).astype(np.int64), parts)
    tree = T.build(points, parts)
    assert sorted(tree.order.tolist()) == list(range(rows * parts))
    for i in range(len(tree.low)):
        inside = points[tree.order[tree.low[i]:tree.high[i]]]
        assert np.sqrt(((inside - points[tree.pivot[i]]) ** 2).sum(axis=1).max()) <= tree.radius[i] * (1 + 1e-12)
        if tree.first[i] < tree.last[i]:
            children = np.arange(tree.first[i], tree.last[i])
            assert tree.low[children[0]] == tree.low[i] and tree.high[children[-1]] == tree.high[i]
            assert (tree.low[children[1:]] == tree.high[children[:-1]]).all()
            if len(children) < T._WIDEST:
                assert (tree.radius[children] <= tree.radius[i] / 2 * (1 + 1e-12)).all()
    books = points.reshape(parts, rows, 2)[:, :20].copy()
    books[:, 10:] *= 3
    placed, sums, counts, compared = T.assign(tree, points, books)
    for p in range(parts):
        mine = points[p * rows:(p + 1) * rows]
        want = ((mine[:, None] - books[p][None]) ** 2).sum(axis=-1).argmin(axis=1)
        assert (placed[p * rows:(p + 1) * rows] == want).all()
        for e in range(20):
            assert counts[p, e] == (want == e).sum() and (sums[p, e] == mine[want == e].sum(axis=0)).all()
    assert compared < len(points)
