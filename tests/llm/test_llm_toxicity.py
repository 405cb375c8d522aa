import math
import random

from llm_frames import docs, plain, read

from warcloom.llm import toxicity as T


def brute_segments(scores):
    """All maximal scoring segments by the recursive definition."""
    def best(lo, hi):
        top = None
        for i in range(lo, hi):
            total = 0.0
            for j in range(i, hi):
                total += scores[j]
                if total > 1e-9 and (top is None or total > top[2] + 1e-9):
                    top = (i, j, total)
        return top

    out, todo = [], [(0, len(scores))]
    while todo:
        lo, hi = todo.pop()
        found = best(lo, hi)
        if found:
            out.append(found)
            todo += [(lo, found[0]), (found[1] + 1, hi)]
    return sorted(out)


def test_segments_equal_recursive_definition():
    draw = random.Random(5)
    for _ in range(300):
        n = draw.randint(1, 25)
        hits = sorted(draw.sample(range(n), draw.randint(1, n)))
        pairs = [(i, draw.choice([1.37, 2.11, 0.53]) + draw.random() / 100) for i in hits]
        scores = [-0.71] * n
        for i, s in pairs:
            scores[i] = s
        got = T.maximal_segments(pairs, -0.71)
        want = brute_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert all(math.isclose(x[2], y[2], abs_tol=1e-9) for x, y in zip(got, want, strict=True))


def test_held_out_accuracy(spark):
    rows = [(i, ("pleasant words here " * 20) + ("vile awful vile scum " * 3 if i % 3 == 0 else "")) for i in range(120)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)], "doc_id long, toxic int")
    from pyspark.sql import functions as F

    model = T.fit(plain(spark, rows), labels, F.col("doc_id") % 5 != 0)
    got = {r.doc_id: r for r in T.score(plain(spark, rows), model).collect()}
    held = [i for i in range(120) if i % 5 == 0]
    assert all(got[i].predicted == int(i % 3 == 0) for i in held)
    assert all(got[i].segments and got[i].segments[0].first_token >= 60 for i in held if i % 3 == 0)


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, "x" * 200_000), (4, "bad"), (4, "bad"), (None, "bad"), (5, "word " * 50_000)]
    model = T.SegmentModel({"bad": 3.0}, -0.2, 1.0, 0.1, [(0.0, 0.01), (1.0, 0.9)])
    got = T.score(docs(spark, rows), model, ["label", "score", "doc_id", "base"]).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if r.doc_id in (1, 2)} == {0.01}
    assert T.score(plain(spark, []), model).count() == 0
    kept = T.drop_predicted(docs(spark, rows), model)
    assert kept.columns == docs(spark, []).columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "5"]


def test_no_labels_scores_zero(spark):
    model = T.fit(plain(spark, [(1, "a b")]), spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.score for r in T.score(plain(spark, [(1, "a b")]), model).collect()] == [0.0]
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert T.fit(plain(spark, [(1, "a b")]), none).scores == {}


def test_query_contract(spark):
    import zlib

    from llm_frames import SF

    from warcloom.llm.queries import QUERIES
    rows = QUERIES["op1_toxicity"](spark, SF).collect()
    assert len(rows) == read(spark, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) for r in rows)
