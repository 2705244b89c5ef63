"""Classifiers and the learned index: held-out accuracy, recall, odd rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD_TEXTS
from tidegauge.llm import queries as Q
from tidegauge.llm.learned_index import balanced_parts, learn, nearest, neighbour_graph
from tidegauge.llm.quality import held_out, learn_rules, score_quality, statistics, train_quality
from tidegauge.llm import toxicity
from tidegauge.llm.toxicity import Network, Vocabulary, score_toxicity, train_toxicity, windows_of, words_of

SF = "/root/testdata/sf0.1"


def auc(score, y):
    rank = np.argsort(np.argsort(score))
    n = y.sum()
    return (rank[y == 1].sum() - n * (n - 1) / 2) / (n * (len(y) - n))


def held_out_figures(spark, query, label, modulus, remainder, sf=SF):
    got = query(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    crc = got.doc_id.astype(str).map(lambda d: zlib.crc32(d.encode()) % modulus == remainder)
    assert (crc == got.held_out).all() and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    rest = got[got.held_out]
    return auc(rest.score.to_numpy(), rest[label].to_numpy()), rest


def test_quality_held_out(spark):
    area, rest = held_out_figures(spark, Q.op8, "quality", 5, 0)
    assert area > 0.93
    assert (rest[rest.quality == 1].predicted == 1).mean() > 0.98


def test_toxicity_held_out(spark):
    area, rest = held_out_figures(spark, Q.op6, "toxic", 4, 2)
    assert area > 0.9
    assert (rest[rest.toxic == 0].predicted == 0).mean() > 0.96


def test_rules_find_a_conjunction_and_compile_alike(spark):
    rng = np.random.default_rng(4)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.6) & (x[:, 1] <= 0.5)).astype(float)
    rules = learn_rules(x, y)
    assert ((rules.score(x) > 0.5) == (y == 1)).mean() > 0.99 and len(rules.rules) < 60
    df = spark.createDataFrame([tuple(map(float, r)) for r in x[:200]], "a double, b double, c double")
    got = [r[0] for r in df.select(rules.column({n: F.col(n) for n in "abc"})).collect()]
    assert np.allclose(got, rules.score(x[:200]))


@pytest.mark.parametrize("labels", [[], [(5, 1), (6, None), (None, 0)], [(5, 1), (6, 0), (7, 0), (7, 0)]])
def test_classifiers_on_odd_rows(spark, docs_of, labels):
    docs = docs_of(ODD_TEXTS, extra=True)
    marked = spark.createDataFrame([(d, v, v) for d, v in labels], "doc_id long, quality int, toxic int")
    good = score_quality(docs, train_quality(docs, marked)).collect()
    bad = score_toxicity(docs, train_toxicity(docs, marked)).collect()
    for out in (good, bad):
        assert len(out) == len(ODD_TEXTS) and all(0 <= r["score"] <= 1 for r in out)
    assert score_quality(docs.limit(0), train_quality(docs, marked)).count() == 0
    assert score_toxicity(docs.limit(0), train_toxicity(docs.limit(0), marked)).count() == 0


def test_statistics_of_whole_text(spark):
    df = spark.createDataFrame([("A bb\tbb!\n\nA bb\tbb!",), (None,)], "t string")
    a, b = df.select(*[c.alias(n) for n, c in statistics(F.col("t")).items()]).collect()
    assert (round(np.expm1(a["log_words"])), a["distinct_words"], a["exclamations"]) == (6, 0.5, 2 / 6)
    assert abs(a["distinct_lines"] - 2 / 3) < 1e-12 and b["word_length"] == 0


def test_held_out_of_null(spark):
    df = spark.createDataFrame([(None,), (12,)], "d long")
    assert [r[0] for r in df.select(held_out(F.col("d"), 4, 2)).collect()] == [zlib.crc32(t) % 4 == 2 for t in (b"", b"12")]


def test_windows_cover_every_word():
    for n in (0, 1, 23, 24, 25, 40, 41, 1000):
        starts = windows_of(n)
        assert starts[0] == 0 and starts[-1] + 24 >= n
        assert all(b - a == 16 for a, b in zip(starts, starts[1:], strict=False))


def test_gradients_of_the_network():
    net = Network(1)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    words = [b"ab", b"c", b"def"]
    x = net.inputs(Vocabulary.of(words)).astype(np.float64) + 0.3
    x[0] = 0
    rng = np.random.default_rng(2)
    mask = np.arange(24) < np.array([[24], [3]])
    ids = np.where(mask, rng.integers(1, 4, (2, 24)), 0)
    _, held = net.forward(x, ids, mask, keep=True)
    g = net.backward(x, ids, mask, held, np.array([1.0, -0.5]))
    value = lambda: net.forward(x, ids, mask)[0] @ np.array([1.0, -0.5])
    for k in ("wf", "ub", "cf", "attend", "out", "bias", "x"):
        p = x if k == "x" else net.p[k]
        at = (1, 3) if k in ("wf", "ub", "x") else (0,) * p.ndim
        before = p[at]
        p[at] = before + 1e-3
        high = value()
        p[at] = before - 1e-3
        low = value()
        p[at] = before
        assert abs((high - low) / 2e-3 - g[k][at]) < 2e-3, k


def test_score_is_that_of_the_most_toxic_window():
    net = Network(3)
    a, b = ["one two three four"] * 12, ["vile words here"]
    text = words_of(" ".join(a + b + a))
    alone = [net.score([text[i:i + 24]])[0] for i in windows_of(len(text))]
    assert np.isclose(net.score([text])[0], max(alone), atol=1e-5)


def test_a_step_takes_the_highest_windows_of_a_long_text(monkeypatch):
    monkeypatch.setattr(toxicity, "STEP_WINDOWS", 3)
    net, texts = Network(3), [[b"w%d" % (i * i % 91) for i in range(n)] for n in (200, 30, 0, 120)]
    words, flat, count = toxicity._numbered(texts)
    first, size, owner = toxicity._lanes(count)
    kept = toxicity._highest(net, net.inputs(Vocabulary.of(words)), np.concatenate([flat, np.zeros(24, np.int64)]), first, size, owner)
    assert (np.diff(kept) > 0).all()
    for i, text in enumerate(texts):
        own = np.flatnonzero(owner == i)
        best = np.array([net.score([text[a:a + 24]])[0] for a in windows_of(len(text))])
        assert set(kept[owner[kept] == i]) == set(own[np.argsort(-best)[:3]])


def test_long_texts_train_within_the_bytes(spark, monkeypatch):
    rng = np.random.default_rng(2)
    plain = lambda n: " ".join(f"plain{i}" for i in rng.integers(0, 300, n))
    rows = [(i, plain(400) + (" you vile stupid fool " if i % 2 else " ") + plain(400)) for i in range(100)]
    docs = spark.createDataFrame(rows + rows[:5] + [(3, "x" * 100_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    assert min(len(t) for _, t in rows) > 4000
    seen = []
    train = toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda texts, y, prior: seen.append((texts, y)) or train(texts, y, prior))
    rest = score_toxicity(docs, train_toxicity(docs, labels)).filter("doc_id >= 60").toPandas()
    texts, y = seen[0]
    assert sorted(texts) == sorted(t for i, t in rows if i < 60) and y.sum() == 30  # each id once
    assert auc(rest.score.to_numpy(), (rest.doc_id % 2).to_numpy()) > 0.9
    monkeypatch.setattr(toxicity, "train", lambda texts, y, prior: seen.append((texts, y)))
    train_toxicity(docs, labels, sample_bytes=50_000)
    sizes = np.array([len(t) for t in seen[1][0]])
    assert all(40_000 < sizes[seen[1][1] == k].sum() <= 50_000 for k in (0, 1))


def test_every_offset_is_scored():
    net = Network(3)
    net.p["out"] *= 3
    texts = [[b"w%d" % (i * i * n % 47) for i in range(n)] for n in (0, 1, 24, 25, 26, 77, 0, 300)]
    want = [max(net.score([t[i:i + 24]])[0] for i in range(max(1, len(t) - 23))) for t in texts]
    assert np.allclose(net.score_all(texts, block=37), want, atol=1e-5)
    assert net.score_all(texts).max() > net.score(texts).max() or (net.score_all(texts) > net.score(texts) + 1e-4).any()


def test_parts_are_balanced_and_follow_the_graph():
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((4, 8)) * 5
    x = np.repeat(centres, 100, axis=0) + rng.standard_normal((400, 8)) * 0.3
    label = balanced_parts(neighbour_graph(x, 8), 4)
    assert np.bincount(label).tolist() == [100] * 4
    assert all(np.bincount(label[i * 100:(i + 1) * 100]).max() >= 95 for i in range(4))


def brute(rows, k=20):
    rows = [(i, np.array(v, dtype=np.float64)) for i, v in rows if i is not None and v is not None and all(e is not None and np.isfinite(e) for e in v) and any(v)]
    out = {}
    for q, v in rows:
        if q % 20 == 0:
            near = sorted(((-float(v @ w), i) for i, w in rows if i != q))[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def test_recall_of_the_query(spark):
    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want, got = brute(vectors), {}
    for r in sorted(Q.op10(spark, SF).collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    assert want.keys() == got.keys()
    recall = [len({i for i, _ in want[q]} & {i for i, _ in got[q]}) / len(want[q]) for q in want]
    assert np.mean(recall) >= 0.9


def test_nearest_on_small_and_odd_tables(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.0, 1.0, -1.0]) for _ in range(3)]) for i in range(90)] + [
        (100, None), (120, [0.0, 0.0, 0.0]), (140, [float("nan"), 1.0, 1.0]), (160, [1.0, None, 1.0]), (180, [1.0, float("inf"), 0.0]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(*r, "own") for r in rows], "vec_id long, embedding array<float>, id string")
    got = {}
    for r in sorted(nearest(df, df.filter("vec_id % 20 = 0")).collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == brute(rows)
    assert nearest(df.limit(0), df).count() == 0


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    from tidegauge.llm import learned_index

    rng = np.random.default_rng(5)
    x = rng.standard_normal((700, 6)).round(1)
    x[100:400] = x[0]  # a third of all rows are equal
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = sorted(map(tuple, nearest(df, df.filter("vec_id % 20 = 0")).collect()))
    assert learn(x).b2.shape == (2,)
    monkeypatch.setattr(learned_index, "CANDIDATE_BLOCK", 50)
    monkeypatch.setattr(learned_index, "QUERY_BLOCK", 7)
    assert sorted(map(tuple, nearest(df, df.filter("vec_id % 20 = 0")).collect())) == want
