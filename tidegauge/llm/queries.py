"""The registered queries of this folder and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.centroids import cluster
from tidegauge.llm.decontaminate import contaminated, find_items
from tidegauge.llm.html_diff import extract_main_text
from tidegauge.llm.learned_index import nearest
from tidegauge.llm.license_scan import BASE, RARE, SLACK, TEMPLATES, license_scan, words_of
from tidegauge.llm.line_dedup import line_dedup
from tidegauge.llm.mixing import mix
from tidegauge.llm.quality import held_out, score_quality, train_quality
from tidegauge.llm.repeats import remove_repeats
from tidegauge.llm.simhash import simhash_classes
from tidegauge.llm.token_files import read_token_files, write_token_files
from tidegauge.llm.toxicity import score_toxicity, train_toxicity
from tidegauge.llm.whitening import whiten
from tidegauge.session import scratch_path, ship_package, table

BPE_FILE = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(BPE_FILE)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return table(spark, sf_dir, "documents")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(documents(spark, sf_dir).select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return extract_main_text(table(spark, sf_dir, "pages"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_items(documents(spark, sf_dir).select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("item_names").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_names", ","), 256).alias("items_sha256"),
        contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_classes(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "fingerprint", "component_id")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held = held_out(F.col("doc_id"), 4, 2)
    network = train_toxicity(docs.filter(~held), table(spark, sf_dir, "labels").filter(~held))
    return score_toxicity(docs, network).select("doc_id", held.alias("held_out"), "score", "predicted")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(documents(spark, sf_dir), path, tokenizer_path())
    return read_token_files(spark, path)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str):
    """Rules learned from the labelled rows of docs that are not held out."""
    held = held_out(F.col("doc_id"), 5, 0)
    return train_quality(docs.filter(~held), table(spark, sf_dir, "labels").filter(~held))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = score_quality(docs, quality_rules(spark, docs, sf_dir))
    return scored.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = F.col("places")
    return license_scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", F.size(places).cast("long").alias("n_base"), F.get(places, F.lit(0)).alias("first_word"),
        F.get(places, F.size(places) - 1).alias("last_word"), F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    out = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    per = F.arrays_zip("whitened", "explained")
    return out.select("vec_id", "n", "deviation", "identity_error", F.posexplode(per).alias("at", "c")).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    out = cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                      F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1,
    "op2_mixing": op2,
    "op3_html_text": op3,
    "op4_decontamination": op4,
    "op5_simhash": op5,
    "op6_toxicity": op6,
    "op7_token_files": op7,
    "op8_quality": op8,
    "op9_repeats": op9,
    "op10_nearest": op10,
    "op11_licenses": op11,
    "op12_whitening": op12,
    "op13_centroids": op13,
    "pipeline": pipeline,
}

ORACLES: dict[str, str] = {}

ORACLES["op1_line_dedup"] = """
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
lines AS (
  SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos
  FROM docs),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
shared AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT doc_id, pos, line, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

ORACLES["op2_mixing"] = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         sha256(coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM docs GROUP BY source),
filled AS (
  SELECT *, 3 * source_size AS cap,
    (sum(source_size) OVER ())::BIGINT AS all_size, (sum(w) OVER ())::BIGINT AS all_w,
    coalesce(sum(3 * source_size) OVER r, 0)::BIGINT AS capped, coalesce(sum(w) OVER r, 0)::BIGINT AS used
  FROM per WINDOW r AS (ORDER BY 3 * source_size / w::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least(cap::DOUBLE, w * max((all_size - capped)::DOUBLE / (all_w - used)::DOUBLE) OVER ()) AS target
  FROM filled),
rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0::DOUBLE) ELSE 0 END AS rate FROM targets),
parts AS (SELECT *, floor(rate)::BIGINT AS whole, (rate - floor(rate)) * 4294967296.0::DOUBLE AS part FROM rates),
draws AS (
  SELECT d.doc_id, d.source, d.size, p.source_size, p.target, k.k,
         d.size * (p.whole + CASE WHEN ('0x' || substr(d.h, (1 + 8 * k.k)::BIGINT, 8))::BIGINT < p.part THEN 1 ELSE 0 END) AS taken
  FROM docs d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source, range(8) AS k(k)),
best AS (
  SELECT source, arg_min(k, (gap, k)) AS k
  FROM (SELECT source, k, abs(sum(taken)::DOUBLE - any_value(target)) AS gap FROM draws GROUP BY source, k) GROUP BY source)
SELECT doc_id, size, source_size, target, taken::BIGINT AS taken
FROM draws JOIN best ON draws.source IS NOT DISTINCT FROM best.source AND draws.k = best.k
"""


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


def _license_sql() -> str:
    postings = [(t, at, w) for t, one in enumerate(TEMPLATES) for at, w in enumerate(one.words)]
    phrases = [(t, ph, at, k, w, len(p)) for t, one in enumerate(TEMPLATES) for ph, (p, at) in enumerate(one.starts) for k, w in enumerate(p)]
    names = [(t, one.label, len(one.words), len(one.phrases)) for t, one in enumerate(TEMPLATES)]
    base = [(b, label, k, w, len(words_of(p))) for b, (p, label) in enumerate(BASE.items()) for k, w in enumerate(words_of(p))]
    return rf"""
WITH posting(t, i, w) AS (VALUES {_values(postings)}),
phrase(t, ph, start, k, w, len) AS (VALUES {_values(phrases)}),
template(t, label, size, n_phrases) AS (VALUES {_values(names)}),
base(b, label, k, w, len) AS (VALUES {_values(base)}),
docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
word AS (
  SELECT * FROM (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS p FROM docs)
  WHERE w IN (SELECT w FROM posting UNION ALL SELECT w FROM base)),
df AS (SELECT w, count(DISTINCT r) AS n FROM word GROUP BY w),
held AS (SELECT DISTINCT r, t, w FROM word JOIN posting USING (w)),
must AS (SELECT DISTINCT t, w FROM phrase),
open AS (
  SELECT r, t FROM held JOIN must USING (t, w) JOIN (SELECT t, count(*) AS m FROM must GROUP BY t) USING (t)
  GROUP BY r, t, m HAVING count(*) = m),
chosen AS (
  SELECT r, t, w FROM held JOIN open USING (r, t) JOIN df USING (w)
  QUALIFY row_number() OVER (PARTITION BY r, t ORDER BY n, w) <= {RARE}),
need AS (SELECT r, t, greatest(2, ceil(count(*) / 2)) AS need FROM chosen JOIN posting USING (t, w) GROUP BY r, t),
vote AS (SELECT r, t, p - i AS o, count(*) AS v FROM chosen JOIN posting USING (t, w) JOIN word USING (r, w) GROUP BY ALL),
agreed AS (SELECT r, t, o FROM vote JOIN need USING (r, t) WHERE v >= need),
stands AS (
  SELECT a.r, a.t, a.o, ph FROM agreed a JOIN phrase f ON f.t = a.t JOIN word x ON x.r = a.r AND x.w = f.w
  WHERE abs(x.p - f.k - (a.o + f.start)) <= {SLACK} GROUP BY a.r, a.t, a.o, ph, len, x.p - f.k HAVING count(*) = len),
verified AS (
  SELECT r, t, o FROM stands JOIN template USING (t) GROUP BY r, t, o, n_phrases HAVING count(DISTINCT ph) = n_phrases),
share AS (
  SELECT v.r, v.t, v.o, count(x.p)::DOUBLE / any_value(size)::DOUBLE AS share
  FROM verified v JOIN template USING (t) JOIN posting q ON q.t = v.t LEFT JOIN word x ON x.r = v.r AND x.p = v.o + q.i AND x.w = q.w
  GROUP BY v.r, v.t, v.o),
place AS (
  SELECT r, b, label, p - k AS s FROM word JOIN base USING (w) GROUP BY r, b, label, len, p - k HAVING count(*) = len),
places AS (
  SELECT r, count(*) AS n_base, min(s) AS first_word, max(s) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM place GROUP BY r),
named AS (SELECT r, label FROM place UNION SELECT r, label FROM share JOIN template USING (t)),
labelled AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM named GROUP BY r),
best AS (SELECT r, max(share) AS score FROM share GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM docs LEFT JOIN places USING (r) LEFT JOIN labelled USING (r) LEFT JOIN best USING (r)
"""


ORACLES["op11_licenses"] = _license_sql()


def _centroid_sql(rounds: int = 5) -> str:
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
away{k} AS MATERIALIZED (
  SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT kept.r, c, list_sum(list_transform(range(1, 65), lambda i: (kept.v[i] - at{k}.v[i]) * (kept.v[i] - at{k}.v[i])))::BIGINT AS d
    FROM kept, at{k}) GROUP BY r)""")
        if k < rounds:
            steps.append(f"""
mean{k} AS (
  SELECT c, list(((s - ((s % n) + n) % n) // n) ORDER BY i) AS v FROM (
    SELECT c, i, sum(v[i])::BIGINT AS s, count(*)::BIGINT AS n FROM away{k} JOIN kept USING (r), range(1, 65) AS dim(i) GROUP BY c, i) GROUP BY c),
at{k + 1} AS MATERIALIZED (SELECT c, coalesce(mean{k}.v, at{k}.v) AS v FROM at{k} LEFT JOIN mean{k} USING (c))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
at0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS c, v FROM (SELECT sha256('2:' || vec_id) AS h, v FROM kept)
  QUALIFY row_number() OVER (ORDER BY h NULLS LAST, v) <= 40),{",".join(steps)}
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(at{rounds}.v, ',')) AS centroid_sha256
FROM away{rounds} JOIN kept USING (r) JOIN at{rounds} USING (c)
"""


ORACLES["op13_centroids"] = _centroid_sql()
