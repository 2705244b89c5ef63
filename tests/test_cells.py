"""The stored cosine index: exact search, recall of partial search, odd vectors."""

from __future__ import annotations

import numpy as np
import pytest

from tidegauge.operators.cells import CellIndex


def exact(ids, x, queries, k):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for i in queries:
        score = np.round(unit @ unit[i], 12)
        out[ids[i]] = [ids[j] for j in np.lexsort((ids, -score))[:k]]
    return out


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 16)) * 2
    return centres[rng.integers(0, 40, 6000)] + rng.normal(size=(6000, 16))


def answers(df):
    got = {}
    for r in df.orderBy("query_id", df["score"].desc(), "id").collect():
        got.setdefault(r["query_id"], []).append(r["id"])
    return got


def test_all_cells_are_exact_and_few_cells_keep_recall(spark, tmp_path, clustered):
    ids = np.arange(len(clustered))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, clustered)], "id long, e array<double>").cache()
    index = CellIndex(spark, str(tmp_path / "i")).build(df, "id", "e", cells=32, sample=3000)
    queries = df.filter("id % 50 = 0")
    want = exact(ids, clustered, ids[::50], 10)
    found = index.search(queries, "id", "e", 10)
    assert answers(found) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    part = answers(index.search(queries, "id", "e", 10, probes=6))
    recall = np.mean([len(set(part[q]) & set(want[q])) / 10 for q in want])
    assert recall >= 0.9
    assert len(list((tmp_path / "i" / "vectors").glob("cell=*"))) == 32


def test_copies_tie_and_odd_vectors_take_no_part(spark, tmp_path):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(30)] + [(100, [3.0, 0.0, 0.0]), (101, None), (102, [0.0] * 3), (103, [float("nan"), 1.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, e array<float>")
    index = CellIndex(spark, str(tmp_path / "a")).build(df, "id", "e")
    got = answers(index.search(df.filter("id IN (5, 100, 102)"), "id", "e", 4))
    assert got == {5: [0, 1, 2, 3], 100: [100, 0, 1, 2]}
    empty = CellIndex(spark, str(tmp_path / "b")).build(df.limit(0), "id", "e")
    assert empty.search(df, "id", "e", 4).count() == 0
