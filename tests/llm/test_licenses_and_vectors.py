"""Licence scan, whitening and centroid clustering against brute force, and on odd tables."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD_TEXTS
from tidegauge.llm import queries as Q
from tidegauge.llm.centroids import cluster, threshold_nearest
from tidegauge.llm.license_scan import BASE, RARE, SLACK, TEMPLATES, license_scan, words_of
from tidegauge.llm.whitening import bidiagonalise, whiten


def python_parts(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [w for w in ("Python", "InArrow", "InPandas", "mapPartitions") if w in plan]


def brute_licenses(texts):
    """(n_words, base places, labels, score) of each text, by trying every beginning of every template."""
    files = [words_of(t or "") for t in texts]
    df = Counter(w for f in files for w in set(f))

    def places(f, p):
        return [i for i in range(len(f) - len(p) + 1) if f[i:i + len(p)] == p]

    out = []
    for f in files:
        base = {label: places(f, words_of(p)) for p, label in BASE.items()}
        labels, score = {label for label, at in base.items() if at}, 0.0
        for t in TEMPLATES:
            if not all(w in f for p, _ in t.starts for w in p):
                continue
            chosen = sorted({w for w in t.words if w in f}, key=lambda w: (df[w], w))[:RARE]
            need = max(2, math.ceil(sum(w in chosen for w in t.words) / 2))
            for o in range(-len(t.words), len(f) + 1):
                hits = [0 <= o + i < len(f) and f[o + i] == w for i, w in enumerate(t.words)]
                votes = sum(h and w in chosen for h, w in zip(hits, t.words))
                if votes >= need and all(any(abs(s - o - at) <= SLACK for s in places(f, p)) for p, at in t.starts):
                    labels.add(t.label)
                    score = max(score, sum(hits) / len(t.words))
        out.append((len(f), sorted(i for at in base.values() for i in at), sorted(labels), score))
    return out


def test_licenses_against_brute_force(docs_of):
    rng = random.Random(11)
    texts = []
    for _ in range(250):
        words = []
        for _ in range(rng.randint(0, 4)):
            part = list(rng.choice(TEMPLATES).words)
            for _ in range(rng.choice([0, 0, 1, 3, 8])):
                at = rng.randrange(len(part)) if part else 0
                part[at:at + rng.randint(0, 1)] = rng.sample(["filler", "the", "license", "all"], rng.randint(0, 2))
            words += part + [rng.choice(["x", "cc", "by", "license", "general"]) for _ in range(rng.randint(0, 5))]
        texts.append("".join(w.upper() + rng.choice([" ", ", ", "\n"]) if rng.random() < 0.2 else w + " " for w in words))
    texts += ["cc by cc by", "CC-BY", "mit license", "general public license\x00general public license", None, ""]
    out = license_scan(docs_of(list(enumerate(texts))))
    got = [(r["n_words"], r["places"], r["labels"], r["score"]) for r in out.orderBy("doc_id").collect()]
    assert got == brute_licenses(texts)
    assert sum(r[3] > 0 for r in got) > 100 and sum(r[3] == 0 for r in got) > 20


def test_licenses_stay_native_and_narrow(docs_of):
    out = license_scan(docs_of([(1, "licensed under cc by-nc 4.0")], extra=True))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert python_parts(out) == [] and "Exchange" not in plan
    row = out.first()
    assert row["labels"] == ["cc-by", "cc-by-nc"] and row["base_labels"] == ["cc-by"] and row["n_words"] == 7
    assert row["label_shares"] == {"cc-by-nc": 1.0}


def test_licenses_of_odd_and_empty_tables(docs_of):
    docs = docs_of(ODD_TEXTS, extra=True)
    out = license_scan(docs)
    assert out.count() == len(ODD_TEXTS) and out.filter("size(labels) > 0").count() == 0
    assert {r["n_words"] for r in out.filter("text is null or text = ''").collect()} == {0}
    assert set(docs.columns) <= set(out.columns) and len(set(out.columns)) == len(out.columns)
    assert license_scan(docs.limit(0)).count() == 0


def test_long_file_of_repeated_notices(docs_of):
    line = "Licensed under the Apache License, Version 2.0. "
    row = license_scan(docs_of([(1, line * 5000 + "all rights reserved " * 3000)])).first()
    assert row["labels"] == ["apache", "reserved"] and len(row["places"]) == 3000 and row["score"] == 1.0


@pytest.fixture
def vectors_of(spark):
    def build(rows, extra=False):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        if extra:
            for name in ("x", "n", "cluster", "deviation", "h", "whitened", "_c", "inertia", "t"):
                df = df.withColumn(name, F.lit("own"))
        return df

    return build


def brute_clusters(rows, k, rounds, dims, scale=256):
    kept = [(i, [math.floor(float(np.float32(c)) * scale) for c in v]) for i, v in rows
            if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    seeds = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    at = [list(v) for _, v in seeds[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(at)) for _, v in kept]

    for _ in range(rounds):
        near = assign()
        for j in range(len(at)):
            own = [v for (_, v), (_, c) in zip(kept, near) if c == j]
            if own:
                at[j] = [sum(col) // len(own) for col in zip(*own)]
    near = assign()
    inertia = Counter()
    for d, j in near:
        inertia[j] += d
    return sorted([(i, j, d, inertia[j], sum(inertia.values()), at[j]) for (i, _), (d, j) in zip(kept, near)], key=repr)


def odd_vectors(rng, dims, n):
    rows = [(i, [rng.choice([0.0, rng.gauss(0, 1), float(rng.randint(-2, 2))]) for _ in range(dims)]) for i in range(n)]
    rows += [(i, list(rows[0][1])) for i in range(n, n + 30)]  # copies
    rows += [rows[1], rows[1], (None, rows[2][1]), (None, None), (900, None), (901, []), (902, [1.0] * (dims - 1)),
             (903, [float("nan")] * dims), (904, [float("inf")] + [0.0] * (dims - 1)), (905, [None] + [0.0] * (dims - 1)), (906, [0.0] * dims)]
    return rows


def test_clusters_against_brute_force(vectors_of):
    rows = odd_vectors(random.Random(13), 6, 120)
    out = cluster(vectors_of(rows, extra=True), k=9, rounds=3, dims=6)
    got = out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid").collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute_clusters(rows, 9, 3, 6)
    assert out.columns.count("cluster") == 1 and "whitened" in out.columns


def test_clusters_of_few_rows_and_empty_tables(vectors_of):
    rows = [(7, [0.5, -0.001]), (7, [0.5, -0.001]), (8, [0.25, 3.0])]
    out = cluster(vectors_of(rows), k=40, rounds=2, dims=2)
    got = sorted([tuple(r) for r in out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid").collect()], key=repr)
    assert got == brute_clusters(rows, 40, 2, 2)
    assert cluster(vectors_of([(1, None)])).count() == 0 and cluster(vectors_of(rows).limit(0)).count() == 0


def test_threshold_walk_meets_ties_and_outliers():
    rng = np.random.default_rng(3)
    for k, d in ((1, 1), (2, 3), (40, 64), (17, 2)):
        centroids = rng.integers(-3, 4, (k, d))
        x = np.concatenate([rng.integers(-5, 6, (300, d)), np.full((1, d), 2**27), np.full((1, d), -2**27)])
        who, best = threshold_nearest(x, centroids)
        away = ((x[:, None, :] - centroids[None]) ** 2).sum(axis=2)
        assert (who == away.argmin(axis=1)).all() and (best == away.min(axis=1)).all()


def brute_whitening(rows, components, scale=64, shift=1_000_000):
    good = [(i, [math.floor(float(np.float32(c)) * scale) + shift for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = min(Counter(len(v) for _, v in good).items(), key=lambda e: (-e[1], e[0]))[0]
    good = [(i, v) for i, v in good if len(v) == d]
    fit = sorted({tuple(v) for _, v in good})
    n, total = len(fit), [sum(col) for col in zip(*fit)]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, total)] for v in fit])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, int((values > 1e-12 * values[0]).sum()))
    deviation = {tuple(v): sum((n * c - s) ** 2 for c, s in zip(v, total)) for _, v in good}
    white = {v: row for v, row in zip(fit, centred @ axes[:, :k] / np.sqrt(values[:k]))}
    return n, [(i, tuple(v), deviation[tuple(v)], white[tuple(v)]) for i, v in good], values[:k] / values.sum()


def same_up_to_signs(got, want):
    signs = np.sign((got * want).sum(axis=0))
    return np.allclose(got * signs, want, atol=1e-8)


@pytest.mark.parametrize("dims", [1, 5, 20])
def test_whitening_against_brute_force(vectors_of, dims):
    rng = random.Random(dims)
    rows = odd_vectors(rng, dims, 150)
    if dims == 20:  # constant and dependent entries: fewer components
        rows = [(i, v and len(v) == 20 and [*v[:4], 7.0, *v[:4], *v[9:13], v[0], *v[:6]] or v) for i, v in rows]
    out = whiten(vectors_of(rows, extra=True))
    got = out.collect()
    n, want, explained = brute_whitening(rows, 16)
    assert len(got) == len(want) and {r["n"] for r in got} == {n}
    assert Counter((r["vec_id"], r["deviation"]) for r in got) == Counter((i, d) for i, _, d, _ in want)
    assert np.allclose(got[0]["explained"], explained, rtol=1e-9) and got[0]["identity_error"] < 1e-9
    key = lambda i, d: (i is None, i or 0, d)
    a = np.array([r["whitened"] for r in sorted(got, key=lambda r: key(r["vec_id"], r["deviation"]))])
    b = np.array([w for i, _, d, w in sorted(want, key=lambda r: key(r[0], r[2]))])
    assert a.shape == b.shape
    gaps = -np.diff(np.append(explained, 0)) / explained[0]
    if gaps.min() > 1e-6:
        assert same_up_to_signs(a, b)


def test_whitening_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = Q.op12(spark, sf).toPandas()
    n, want, explained = brute_whitening(rows, 16)
    assert (got["n"] == n).all() and got["identity_error"].max() < 1e-9
    assert dict(zip(got["vec_id"], got["deviation"])) == {i: d for i, _, d, _ in want}
    wide = got.pivot(index="vec_id", columns="component", values="whitened")
    assert list(wide.columns) == list(range(1, 17))
    assert same_up_to_signs(wide.to_numpy(), np.array([w for i, _, _, w in sorted(want, key=lambda r: r[0])]))
    assert np.allclose(sorted(got["explained"].unique(), reverse=True), explained, rtol=1e-9)


def test_whitening_of_one_vector_and_empty_tables(vectors_of):
    one = whiten(vectors_of([(1, [0.5, 2.0]), (2, [0.5, 2.0])])).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, [], [], 0.0)] * 2
    assert whiten(vectors_of([(1, None)])).count() == 0
    assert whiten(vectors_of([(1, [0.5])]).limit(0)).count() == 0


def test_bidiagonal_form_of_equal_and_zero_singular_values():
    rng = np.random.default_rng(4)
    left, _ = np.linalg.qr(rng.standard_normal((50, 8)))
    right, _ = np.linalg.qr(rng.standard_normal((8, 8)))
    for sizes in ([5, 5, 5, 2, 2, 1, 0, 0], [3] * 8, [1e6, 1e3, 1, 1e-3, 0, 0, 0, 0]):
        x = left * np.array(sizes, float) @ right
        axes, form = bidiagonalise(lambda p: (x.T @ (x @ p), float((x @ p) @ (x @ p))), 8)
        assert np.allclose(axes.T @ axes, np.eye(8), atol=1e-12)
        assert np.allclose(np.linalg.svd(form)[1], sorted(sizes, reverse=True), atol=1e-9 * max(sizes))
