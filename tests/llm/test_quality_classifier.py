import os
import zlib

import numpy as np
import pytest

from chronicell.llm import quality_classifier as Q
from chronicell.llm.base import table

SMALL = "/root/testdata/sf0.01"


def test_isotonic_fit_is_the_best_monotone_one():
    rng = np.random.default_rng(0)
    weight = rng.integers(0, 4, 12).astype(float)
    total = np.array([rng.binomial(int(w), k / 12) for k, w in enumerate(weight)], float)
    steps = Q.pool_adjacent(weight, total)
    assert (np.diff(steps) >= -1e-12).all()
    used = weight > 0
    mean = total[used] / weight[used]
    loss = (weight[used] * (mean - steps[used]) ** 2).sum()
    # minimax form of the isotonic regression
    n, w = used.sum(), weight[used]
    best = [max(min((w[a : b + 1] * mean[a : b + 1]).sum() / w[a : b + 1].sum() for b in range(k, n)) for a in range(k + 1)) for k in range(n)]
    assert loss == pytest.approx((w * (mean - np.array(best)) ** 2).sum())
    assert (Q.pool_adjacent(np.zeros(3), np.zeros(3)) == 0.5).all()


def test_statistics_of_odd_texts():
    x = Q.statistics([b"", b"A a a\nA a a\n\n", "é! |#".encode(), b" \n "])
    names = dict(zip(Q.STATISTICS, x.T))
    assert (x[0] == 0).all() and x.shape == (4, len(Q.STATISTICS)) and np.isfinite(x).all()
    assert names["repeated_lines"][1] == 0.5 and names["repeated_next"][1] == pytest.approx(5 / 6)
    assert names["pipes"][2] == 1 and names["exclamations"][2] == 1


def test_the_fit_matches_dense_equations(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, len(Q.STATISTICS)))
    y = (x[:, 0] > 0).astype(float)
    rows = spark.createDataFrame([(r.tolist(), float(v)) for r, v in zip(x, y)], "x array<double>, y double").repartition(5)
    model = Q.fit(rows, features=16)
    z = model.features(x)
    dense = np.linalg.solve(z.T @ z + np.diag([Q.RIDGE * 300] * 16 + [3e-7]), z.T @ y)
    assert np.allclose(dense, model.coefficients, atol=1e-6)


def test_awkward_rows(spark, docs_of):
    docs = docs_of([(1, "fine words in a row."), (1, "fine words in a row."), (2, None), (3, ""), (None, "x"), (4, "w " * 30000)])
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, None), (None, 1, 0), (99, 1, 1)], "doc_id bigint, quality int, toxic int")
    got = Q.score_documents(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert Q.score_documents(docs.limit(0), labels).count() == 0
    assert {r.score for r in Q.score_documents(docs, labels.limit(0)).collect()} == {0.5}


def test_clashing_columns(spark, docs_of):
    docs = docs_of([(k, "fine words in a row. " * k) for k in range(6)])
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(6)], "doc_id bigint, quality int, toxic int")
    plain = sorted(map(tuple, Q.score_documents(docs, labels).collect()))
    odd = docs.selectExpr("*", "'x' AS x", "2 AS y", "3 AS score", "4 AS quality", "5 AS held_out", "6 AS predicted", "7 AS bucket")
    more = labels.selectExpr("*", "'t' AS text", "9 AS y", "'x' AS x", "1 AS score")
    assert sorted(map(tuple, Q.score_documents(odd, more).collect())) == plain


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no tables")
def test_held_out_accuracy(spark):
    rows = Q.op1_quality_classifier(spark, SMALL).join(table(spark, SMALL, "labels"), "doc_id").filter("held_out").collect()
    assert len(rows) > 80 and np.mean([r.predicted == r.quality for r in rows]) > 0.95
