"""Quality classifier: a sparse ensemble of rules, compiled into column expressions.

Shallow boosted trees over statistics of the text propose rules (the conjunctions on their
paths); a lasso logistic regression keeps few of them and weighs them. Statistics and rules
are built-in expressions, so scoring is one projection over the documents.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import BLANKS, ROW, packed, unpacked

#: Labelled rows that the rules are learned from: those of smallest id hash.
SAMPLE = 20_000
THRESHOLD = 0.3


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a whole text; NULL is the empty text. Ratios are 0 where nothing is counted."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    chars = F.length(t)
    words = F.filter(F.split(F.translate(t, BLANKS[1:], " " * 5), " ", -1), lambda w: w != "")
    n_words = F.size(words)
    lines = F.split(t, "\n", -1)

    def per(count: Column, of: Column) -> Column:
        return F.when(of > 0, count / of).otherwise(F.lit(0.0))

    return {
        "log_words": F.log1p(n_words.cast("double")),
        "word_length": per(chars.cast("double"), n_words),
        "distinct_words": per(F.size(F.array_distinct(words)).cast("double"), n_words),
        "distinct_lines": per(F.size(F.array_distinct(lines)).cast("double"), F.size(lines)),
        "words_per_line": F.log1p(per(n_words.cast("double"), F.size(lines))),
        "symbols": per(F.regexp_count(t, F.lit(r"[%&$*#@|<>{}\[\]=+~^_\\/]")).cast("double"), n_words),
        "exclamations": per(F.regexp_count(t, F.lit("!")).cast("double"), n_words),
        "stops": per(F.regexp_count(t, F.lit(r"[.?](?=\s|$)")).cast("double"), n_words),
        "commas": per(F.regexp_count(t, F.lit("[,;:]")).cast("double"), n_words),
        "upper_runs": per(F.regexp_count(t, F.lit(r"\p{Lu}{2,}")).cast("double"), n_words),
        "digit_runs": per(F.regexp_count(t, F.lit("[0-9]+")).cast("double"), n_words),
        "wide_bytes": per((F.octet_length(t) - chars).cast("double"), chars),
        "links": per(F.regexp_count(t, F.lit(r"https?://|www\.|@")).cast("double"), n_words),
    }


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above, bound), all of which must hold


@dataclass
class Rules:
    intercept: float
    rules: list[tuple[Rule, float]]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for rule, weight in self.rules:
            z += weight * _holds(rule, x)
        return 1 / (1 + np.exp(-z))

    def column(self, stats: dict[str, Column]) -> Column:
        """The score as an expression over columns of the statistics."""
        names = list(stats)

        def met(rule: Rule) -> Column:
            return reduce(lambda a, b: a & b, [stats[names[k]] > b if above else stats[names[k]] <= b for k, above, b in rule])

        z = reduce(lambda a, b: a + b, [F.when(met(r), F.lit(w)).otherwise(0.0) for r, w in self.rules], F.lit(self.intercept))
        return 1 / (1 + F.exp(-z))


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([x[:, k] > b if above else x[:, k] <= b for k, above, b in rule])


def _tree(x: np.ndarray, codes: np.ndarray, bounds: list[np.ndarray], grad: np.ndarray, hess: np.ndarray,
          rows: np.ndarray, depth: int, least: int, path: Rule, out: list[tuple[Rule, float]]) -> None:
    """Grows a regression tree on gradients; every node below the root gives a rule."""
    value = grad[rows].sum() / (hess[rows].sum() + 1.0)
    if path:
        out.append((path, value))
    if depth == 0 or len(rows) < 2 * least:
        return
    best = (1e-6, -1, -1)
    g_all, h_all = grad[rows].sum(), hess[rows].sum()
    for k, cuts in enumerate(bounds):
        if not len(cuts):
            continue
        code = codes[rows, k]
        g, h, n = (np.cumsum(np.bincount(code, w, len(cuts) + 1))[:-1] for w in (grad[rows], hess[rows], np.ones(len(rows))))
        ok = (n >= least) & (len(rows) - n >= least)
        gain = np.where(ok, g**2 / (h + 1) + (g_all - g) ** 2 / (h_all - h + 1) - g_all**2 / (h_all + 1), -1)
        at = int(gain.argmax())
        if gain[at] > best[0]:
            best = (gain[at], k, at)
    _, k, at = best
    if k < 0:
        return
    low = codes[rows, k] <= at
    for above, part in ((False, rows[low]), (True, rows[~low])):
        _tree(x, codes, bounds, grad, hess, part, depth - 1, least, (*path, (k, above, float(bounds[k][at]))), out)


def learn_rules(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, penalty: float = 0.002, steps: int = 400) -> Rules:
    """Rules for P(y = 1 | x); with one class only, or no rows, a constant."""
    rate = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(rate / (1 - rate)))
    if len(y) == 0 or y.min() == y.max():
        return Rules(base, [])
    bounds = [np.unique(np.quantile(x[:, k], np.linspace(0.01, 0.99, 63), method="lower")) for k in range(x.shape[1])]
    codes = np.stack([np.searchsorted(b, x[:, k], "left") for k, b in enumerate(bounds)], axis=1)
    rng, z = np.random.default_rng(8), np.full(len(y), base)
    rules: dict[Rule, None] = {}
    least = max(3, len(y) // 1000)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        rows = np.flatnonzero(rng.random(len(y)) < 0.6)
        found: list[tuple[Rule, float]] = []
        _tree(x, codes, bounds, y - p, p * (1 - p), rows, depth, least, (), found)
        inner = {r[:-1] for r, _ in found}
        for rule, value in found:
            rules[tuple(sorted(rule))] = None
            if rule not in inner:
                z += 0.3 * value * _holds(rule, x)
    names = list(rules)
    if not names:
        return Rules(base, [])
    a = np.stack([_holds(r, x) for r in names], axis=1).astype(np.float64)
    _, one = np.unique(a, axis=1, return_index=True)  # of rules that hold alike, the first
    names, a = [names[i] for i in np.sort(one)], a[:, np.sort(one)]
    spread = np.maximum(a.std(axis=0), 0.05)
    b = a / spread
    lip = 0.25 * np.linalg.norm(np.hstack([b, np.ones((len(b), 1))]), 2) ** 2 / len(b)
    w, c = np.zeros(b.shape[1]), base
    vw, vc, t = w, c, 1.0
    for _ in range(steps):  # accelerated proximal gradient
        r = 1 / (1 + np.exp(-(b @ vw + vc))) - y
        nw = vw - b.T @ r / len(y) / lip
        nw = np.sign(nw) * np.maximum(np.abs(nw) - penalty / lip, 0)
        nc = vc - r.mean() / lip
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vc = nw + (t - 1) / nt * (nw - w), nc + (t - 1) / nt * (nc - c)
        w, c, t = nw, nc, nt
    return Rules(float(c), [(r, float(v / s)) for r, v, s in zip(names, w, spread, strict=True) if v != 0])


def held_out(id_col: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves `remainder`; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def train_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", sample: int = SAMPLE) -> Rules:
    """Rules learned from labelled documents; unlabelled ones and NULL labels are passed over.

    Labels join on the id; the `sample` labelled ids of smallest hash are taken, so the
    broadcast ids and what reaches the driver (a row of statistics each) are bounded.
    """
    marked = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).dropna().dropDuplicates(["_id"])
    marked = marked.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    stats = statistics(F.col(f"`{text_col}`"))
    rows = docs.select(F.col(f"`{id_col}`").alias("_d"), F.col(f"`{text_col}`")).join(F.broadcast(marked), F.col("_d") == F.col("_id"))
    got = rows.select("_y", "_d", *[c.alias(n) for n, c in stats.items()]).toPandas().sort_values(["_d", *stats])
    return learn_rules(got[list(stats)].to_numpy(np.float64).reshape(-1, len(stats)), got["_y"].to_numpy(np.float64))


def score_quality(docs: DataFrame, rules: Rules, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Adds score (0 to 1) and predicted (1 if score >= threshold).

    No shuffle, narrow steps. A projection counts the statistics, where the words that they share
    are split once; above it they pass through a one-element explode, as a filter on the
    prediction would otherwise be pushed below them and count them anew in every rule.
    NULL and empty texts get the score of their statistics (all 0). Rows are kept as they are;
    columns named score or predicted are replaced.
    """
    rows = packed(docs)
    stats = statistics(F.col(ROW).getField(text_col))
    counted = rows.select(ROW, F.struct(*[c.alias(n) for n, c in stats.items()]).alias("_counted"))
    seen = counted.select(ROW, F.explode(F.array("_counted")).alias("_st"))
    scored = seen.select(ROW, rules.column({n: F.col("_st").getField(n) for n in stats}).alias("_s"))
    return unpacked(scored, docs.columns, {"score": F.col("_s"), "predicted": (F.col("_s") >= threshold).cast("int")})
