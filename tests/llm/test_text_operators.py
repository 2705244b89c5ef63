"""Line dedup, mixing, decontamination, SimHash and token files on small tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.compare import differences, duck
from tests.llm import brute
from tests.llm.conftest import ODD_TEXTS
from tidegauge.llm import queries as Q
from tidegauge.llm.decontaminate import contaminated, find_items
from tidegauge.llm.line_dedup import line_dedup
from tidegauge.llm.mixing import mix, repeated
from tidegauge.llm.simhash import fingerprint, fingerprint_links, keep_one, simhash_classes
from tidegauge.llm.token_files import Encoder, compress, expand, read_token_files, write_token_files


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def table_rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_matches_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    assert differences(spark, duck(sf), name, Q.QUERIES[name], Q.ORACLES[name], sf) == []


def test_lines_of_few_documents_stay(spark, docs_of):
    line = "This line is long enough to count"
    docs = docs_of([(1, f"a\n{line}\nb\n{line.upper()}  "), (2, f"\t{line}"), (3, f"{line}\nend"), (4, "short\nshort"), (5, None), (6, "")])
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_text"]) for r in line_dedup(docs).collect()}
    assert got == {1: (4, 2, "a\nb"), 2: (1, 1, ""), 3: (2, 0, f"{line}\nend"), 4: (2, 0, "short\nshort"), 5: (1, 0, ""), 6: (1, 0, "")}


def test_lines_repeated_rows_and_null_id(spark, docs_of):
    line = "This line is long enough to count"
    docs = docs_of([(None, line), (1, line), (2, line), (2, line), (2, "other")], extra=True)
    out = line_dedup(docs)
    assert sorted((r["doc_id"] or 0, r["n_dropped"], r["kept_text"]) for r in out.collect()) == [
        (0, 1, ""), (1, 1, ""), (2, 0, line), (2, 0, line), (2, 0, "other")]
    assert [c for c in docs.columns if c != "kept_text"] == [c for c in out.columns if c not in ("n_lines", "n_dropped", "kept_text")]


@pytest.mark.parametrize("apply", [
    line_dedup, mix, simhash_classes, keep_one,
    lambda d: find_items(d, d.sparkSession.createDataFrame([(1, "a b"), (None, None), (2, "")], "item_id long, text string")),
], ids=["lines", "mix", "classes", "keep_one", "items"])
def test_odd_and_empty_tables(spark, docs_of, apply):
    out = apply(docs_of(ODD_TEXTS, extra=True))
    assert out.count() > 0
    assert apply(docs_of(ODD_TEXTS, extra=True).limit(0)).count() == 0


def test_mix_takes_near_targets_and_never_more_than_three(spark, docs_of):
    rng = random.Random(3)
    docs = docs_of([(i, "w " * rng.randint(0, 40), rng.choice(["a", "b", "c", None, "é"])) for i in range(3000)])
    out = mix(docs)
    per = out.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("copies").alias("most")).collect()
    assert all(abs(r["taken"] - r["target"]) < 0.03 * r["target"] and r["most"] <= 3 for r in per)
    total = out.agg(F.sum("size")).first()[0]
    assert abs(sum(r["target"] for r in per) - total) < 1e-6 * total
    assert rows(out) == rows(mix(docs))
    copies = repeated(out, docs.columns)
    assert copies.count() == out.agg(F.sum("copies")).first()[0] and copies.columns == docs.columns


def test_mix_cap_reshares(spark, docs_of):
    out = mix(docs_of([(1, "w " * 90, "a"), (2, "w", "b"), (3, "w " * 9, "c"), (4, "", "d")]))
    got = {r["source"]: r["target"] for r in out.collect()}
    assert got["b"] == 3.0 and got["c"] == 27.0 and got["d"] == 0.0 and got["a"] == 70.0


def test_items_against_brute_force(spark, docs_of):
    rng = random.Random(5)
    letters = ["a", "B", "c", "é", "7", "ñu"]
    text = lambda n: rng.choice(["", "! "]) + "".join(rng.choice(letters) + rng.choice([" ", ", ", "\n"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 5, 12, 13, 14, 30]) or 0)) for i in range(40)] + [(90, None), (91, "..."), (92, "q9"), (93, "q9")]
    docs = [(i, text(rng.randint(0, 60)) + (items[rng.randrange(40)][1] if i % 3 else "") + text(9)) for i in range(200)] + [(500, None), (501, ""), (502, "q9 x")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    out = find_items(docs_of(docs), frame)
    got = table_rows(out, "doc_id", "n_words", "n_hit", F.size("item_names"), F.sha2(F.array_join("item_names", ","), 256), contaminated(F.col("n_words"), F.col("n_hit")))
    assert sorted(got) == sorted(brute.decontamination(docs, items))


def test_items_in_several_blocks(spark, docs_of, monkeypatch):
    from tidegauge.llm import decontaminate

    items = [(i, f"alpha{i} beta{i} gamma{i}") for i in range(12)]
    docs = [(i, f"x alpha{i} beta{i} gamma{i} y alpha{(i + 5) % 12} beta{(i + 5) % 12} gamma{(i + 5) % 12}") for i in range(12)] + [(99, None)]
    frame = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 60)
    got = table_rows(find_items(docs_of(docs), frame), "doc_id", "n_words", "n_hit", F.size("item_names"))
    assert sorted(got) == sorted(r[:4] for r in brute.decontamination(docs, items))


def test_decontamination_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = table_rows(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id", "text")
    items = table_rows(spark.read.parquet(f"{sf}/benchmark.parquet"), "item_id", "text")
    assert rows(Q.op4(spark, sf)) == sorted(brute.decontamination(docs, items), key=repr)


def test_fingerprints(spark):
    for text in [None, "", " \t", "One", "a b C", "a b c d", "É b c d e f g", "the " * 999, "x" * 100000]:
        assert fingerprint(text) & (1 << 64) - 1 == brute.fingerprint(text)


def test_links_against_brute_force(spark):
    rng = random.Random(9)
    values = {0, (1 << 64) - 1}
    for _ in range(60):
        base = rng.getrandbits(64)
        values.add(base)
        for k in (1, 1, 2, 3, 4, 5, 6):
            values.add(base ^ sum(1 << b for b in rng.sample(range(64), k)))
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    got = table_rows(fingerprint_links(spark.createDataFrame([(v,) for v in signed], "_fp long")), "a", "b")
    want = {(a, b) for i, b in enumerate(signed) for a in signed[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4}
    assert len(got) == len(set(got)) and set(got) == want


def test_simhash_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = table_rows(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id", "text")
    assert rows(Q.op5(spark, sf)) == sorted(brute.simhash(docs), key=repr)


def test_keep_one_of_each_group(spark, docs_of):
    base = " ".join(f"word{i}" for i in range(400))
    docs = docs_of([(3, base), (1, base), (2, base + " more"), (9, "quite another text of some words"), (9, "quite another text of some words"), (None, base)])
    assert sorted(r["doc_id"] for r in keep_one(docs).collect()) == [1, 9]


def test_control_bytes_round_trip():
    rng = np.random.default_rng(2)
    for n in (0, 1, 3, 4, 5, 1000):
        values = rng.integers(0, 1 << 32, n, dtype=np.uint64) >> rng.integers(0, 32, n).astype(np.uint64)
        assert (expand(compress(values), n) == values).all()


def test_encoder_equals_the_library():
    encoder = Encoder(Q.tokenizer_path())
    rng = random.Random(1)
    letters = "ab '\n\t 1½.! 日<|>\x1c\x85é,  "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + ["<|endoftext|> a<|endoftext|>", "it's don't  'll"]
    parts = ["a", "Été", "word", "9", "'", "'s", "_", ".", "***", "\n", "\n\n", "\n\n\n", " ", "  ", "\u3000", "\u0301", "!", "ʰ", "Ⅷ", "<|endoftext|>", ".\nThe"]
    texts += ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(6000)]
    want = [encoder.library.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        assert [np.frombuffer(r, encoder.kind).tolist() for r in encoder.encode(texts)] == want


def test_a_batch_of_texts_is_never_held_as_strings():
    import tracemalloc

    import pyarrow as pa

    from tidegauge.llm.token_files import _tokenize

    batch = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array([f"{k}" + " of the word" * 90_000 for k in range(60)])], names=["doc", "text"])
    run = _tokenize(Q.tokenizer_path(), 2)
    next(run(iter([batch.slice(0, 1)])))  # loads the library
    tracemalloc.start()
    n = sum(out.num_rows for out in run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 60 and peak < 48 << 20  # of 65 million characters


def test_token_files_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = table_rows(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id", "text")
    assert sorted(rows(Q.op7(spark, sf))) == brute.tokens(docs, Encoder(Q.tokenizer_path()).library)


def test_token_files_round_trip_of_odd_texts(spark, docs_of, tmp_path):
    path = f"file://{tmp_path}/tokens"
    write_token_files(docs_of(ODD_TEXTS, extra=True), path, Q.tokenizer_path())
    out = read_token_files(spark, path, with_ids=True).orderBy("start").collect()
    library = Encoder(Q.tokenizer_path()).library
    want = sorted(([*library.encode(t or "", add_special_tokens=False).ids, 2] for _, t in ODD_TEXTS), key=repr)
    assert sorted((r["ids"] for r in out), key=repr) == want
    assert [r["start"] for r in out] == np.cumsum([0, *[r["n_tokens"] for r in out]])[:-1].tolist()
    ids = [r["doc_id"] for r in out]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    write_token_files(docs_of(ODD_TEXTS).limit(0), path, Q.tokenizer_path())
    assert read_token_files(spark, path).count() == 0
