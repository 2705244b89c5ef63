"""Scans over long series cut into slices: each slice is summarised, the summaries are combined
per symbol (one row a slice), and what precedes or follows a slice is handed back to its rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.operators.segments import number_rows
from tidegauge.session import cut_lineage

SLICE, ROW_NUMBER, OVERLAP = "_slice", "_rn", "_overlap"


def cut(bars: DataFrame, rows: int) -> DataFrame:
    """Bars keyed by (symbol, unix_timestamp) in slices of ``rows`` rows; no task sees a whole symbol."""
    return number_rows(bars).withColumn(SLICE, F.floor(F.col(ROW_NUMBER) / F.lit(rows)))


def with_overlap(df: DataFrame, rows: int, overlap: int) -> DataFrame:
    """The last ``overlap`` rows of each slice stand before the next one too, marked ``_overlap``."""
    if overlap > rows:
        raise ValueError(f"slices of {rows} rows are shorter than the overlap of {overlap}")
    late = F.pmod(F.col(ROW_NUMBER), F.lit(rows)) >= rows - overlap
    both = F.explode(F.when(late, F.array(F.col(SLICE), F.col(SLICE) + 1)).otherwise(F.array(SLICE)))
    return df.withColumn("_to", both).withColumn(OVERLAP, F.col("_to") != F.col(SLICE)).drop(SLICE).withColumnRenamed("_to", SLICE)


def carried(df: DataFrame, by: list[str], totals: dict[str, Column], edges: dict[str, Column]) -> DataFrame:
    """Adds to every row what ``edges`` make of the summaries of its series' other slices.

    ``totals`` are aggregates per slice; an edge is a window expression over them, built with
    :func:`before` or :func:`after`.  One small row per slice is shuffled and joined back.
    """
    summary = df.groupBy(*by, SLICE).agg(*(c.alias(n) for n, c in totals.items()))
    found = summary.select(*by, SLICE, *(c.alias(n) for n, c in edges.items()))
    return df.join(found, [*by, SLICE])


def before(by: list[str]) -> Window:
    return Window.partitionBy(*by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)


def after(by: list[str]) -> Window:
    return Window.partitionBy(*by).orderBy(F.col(SLICE).desc()).rowsBetween(Window.unboundedPreceding, -1)


# -- exponential mean: affine maps ------------------------------------------------------------
def _runs(values: np.ndarray, alpha: float, mean: float | None, weight: float) -> tuple[np.ndarray, float | None, float]:
    """The unseeded exponential mean behind each value, from a mean and the weight that its age left it."""
    out = np.empty(len(values))
    for i, v in enumerate(values):
        if mean is not None:
            weight *= 1 - alpha
        if not np.isnan(v):
            mean = v if mean is None else (weight * mean + alpha * v) / (weight + alpha)
            weight = 1.0
        out[i] = np.nan if mean is None else mean
    return out, mean, weight


def exponential_scan(df: DataFrame, by: list[str], order: str, x: str, n: int, out: str) -> DataFrame:
    """Exponential mean of span ``n`` (first value as start, gaps age it) over sliced rows.

    A slice maps the mean before it to the mean behind it, affinely from its first value on;
    a slice is summarised by that map, the maps are applied in turn per series (one row a
    slice), and each slice then runs from its own start.
    """
    if not by:
        return exponential_scan(df.withColumn("_one", F.lit(0)), ["_one"], order, x, n, out).drop("_one")
    alpha, decay = 2.0 / (n + 1), 1 - 2.0 / (n + 1)
    df = cut_lineage(df)  # three passes read it
    types = dict(df.dtypes)
    keys = "".join(f"{k} {types[k]}, " for k in by)

    def summary(pdf: pd.DataFrame) -> pd.DataFrame:
        values = pdf.sort_values(order, kind="stable")[x].to_numpy(dtype=float)
        known = np.flatnonzero(~np.isnan(values))
        row = {k: pdf[k].iloc[0] for k in [*by, SLICE]}
        if len(known):
            first = known[0]
            rest = values[first:].copy()
            rest[0] = 0.0
            zero, weight = _runs(rest, alpha, None, 1.0)[1:]
            gaps = np.diff(np.append(known, len(values)))[:-1]
            shrink = float(np.prod([decay**g / (decay**g + alpha) for g in gaps])) if len(known) > 1 else 1.0
            row |= {"_lead": int(first), "_first": float(values[first]), "_shrink": shrink, "_add": float(zero), "_weight": float(weight)}
        else:
            row |= {"_lead": len(values), "_first": None, "_shrink": 1.0, "_add": 0.0, "_weight": float(decay ** len(values))}
        return pd.DataFrame([row])

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        mean, weight, rows = None, 1.0, []
        for r in pdf.sort_values(SLICE).itertuples(index=False):
            r = dict(zip(pdf.columns, r, strict=True))
            rows.append({**{k: r[k] for k in [*by, SLICE]}, "_mean": mean, "_age": weight})
            if r["_first"] is None or np.isnan(r["_first"]):
                weight = weight * r["_weight"] if mean is not None else 1.0
                continue
            held = weight * decay ** (r["_lead"] + 1)
            start = r["_first"] if mean is None else (held * mean + alpha * r["_first"]) / (held + alpha)
            mean, weight = r["_shrink"] * start + r["_add"], r["_weight"]
        return pd.DataFrame(rows)

    def finish(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values(order, kind="stable")
        mean, weight = right["_mean"].iloc[0], right["_age"].iloc[0]
        values = _runs(left[x].to_numpy(dtype=float), alpha, None if mean is None or np.isnan(mean) else float(mean), float(weight))[0]
        return left[[*by, SLICE, order]].assign(**{out: values})

    source = df.select(*by, SLICE, order, F.col(x).cast("double").alias(x))
    slim = f"{keys}{SLICE} {types[SLICE]}, "
    sums = source.groupBy(*by, SLICE).applyInPandas(
        summary, f"{slim}_lead long, _first double, _shrink double, _add double, _weight double")
    starts = sums.groupBy(*by).applyInPandas(compose, f"{slim}_mean double, _age double")
    found = source.groupBy(*by, SLICE).cogroup(starts.groupBy(*by, SLICE)).applyInPandas(finish, f"{slim}{order} {types[order]}, {out} double")
    found = found.withColumn(out, F.when(~F.isnan(out), F.col(out)))
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in by] + [F.col(f"l.{c}") == F.col(f"r.{c}") for c in (SLICE, order)]
    on = same[0]
    for c in same[1:]:
        on &= c
    return df.alias("l").join(found.alias("r"), on, "left").select("l.*", f"r.{out}")


# -- interpolation: nearest known values on both sides ------------------------------------------
def interpolated(df: DataFrame, by: list[str], order: str, columns: list[str]) -> DataFrame:
    """Linear in ``order`` between known values, however many slices lie between them; leading
    gaps stay NULL, trailing gaps repeat the last value."""
    at = F.col(order).cast("double")
    known = {c: F.when(F.col(c).isNotNull(), F.struct(at.alias("t"), F.col(c).cast("double").alias("v"))) for c in columns}
    totals, edges = {}, {}
    for c in columns:
        totals[f"_{c}_first"], totals[f"_{c}_last"] = F.min(known[c]), F.max(known[c])  # structs: by time
        edges[f"_{c}_back"] = F.last(f"_{c}_last", True).over(before(by))
        edges[f"_{c}_ahead"] = F.last(f"_{c}_first", True).over(after(by))
    df = carried(df, by, totals, edges)
    up = Window.partitionBy(*by, SLICE).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*by, SLICE).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, 0)

    def filled(c: str) -> Column:
        back = F.coalesce(F.last(known[c], True).over(up), F.col(f"_{c}_back"))
        ahead = F.coalesce(F.last(known[c], True).over(down), F.col(f"_{c}_ahead"))
        share = (at - back["t"]) / (ahead["t"] - back["t"])
        return F.when(F.col(c).isNotNull(), F.col(c).cast("double")).when(
            ahead.isNotNull(), back["v"] + (ahead["v"] - back["v"]) * share).otherwise(back["v"])

    names = [c for c in df.columns if c not in edges]
    return df.select(*((filled(c).alias(c) if c in columns else F.col(c)) for c in names))


# -- missing ranges: gaps between neighbours ----------------------------------------------------
def missing_ranges(rows: DataFrame, by: list[str], order: str, step: int, width: int) -> DataFrame:
    """(by, first_missing, last_missing, n_missing) between the rows of each series, which
    should stand ``step`` apart; as many rows as there are gaps.

    Series are cut at multiples of ``width``; a slice's last row finds its successor in the
    summary of the next slice that has rows.
    """
    sliced = rows.select(*by, order).withColumn(SLICE, F.floor(F.col(order) / width))
    df = carried(sliced, by, {"_first": F.min(order)}, {"_next": F.last("_first").over(
        Window.partitionBy(*by).orderBy(F.col(SLICE).desc()).rowsBetween(-1, -1))})
    following = F.coalesce(F.lead(order).over(Window.partitionBy(*by, SLICE).orderBy(order)), F.col("_next"))
    gaps = df.withColumn("_following", following).filter(F.col("_following") - F.col(order) > step)
    return gaps.select(
        *by, (F.col(order) + step).alias("first_missing"), (F.col("_following") - step).alias("last_missing"),
        ((F.col("_following") - F.col(order)) / step - 1).cast("long").alias("n_missing"))
