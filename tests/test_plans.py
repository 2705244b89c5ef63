"""Strategy, index and stream behaviour."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegauge.functions.labels import index_label, lexicon_score, sentiment_label
from tidegauge.plans import fear_greed as fg
from tidegauge.plans import strategy as st
from tidegauge.plans.fear_greed import score_news
from tidegauge.streaming import incremental as inc

DAY0 = dt.date(2020, 1, 1)


def series(spark, **columns):
    n = len(next(iter(columns.values())))
    data = {"date": [DAY0 + dt.timedelta(days=i) for i in range(n)], **columns}
    return spark.createDataFrame(pd.DataFrame(data))


def test_signals_and_equity_equal_a_step_by_step_run(spark):
    rng = np.random.default_rng(3)
    z = rng.normal(0, 1.5, 400).cumsum() * 0.3
    price = 100 + rng.normal(0, 1, 400).cumsum()
    s = st.Settings(capital=1000.0)
    df = st.equity(st.signals(series(spark, combined_zscore=z, close=price), s), s)
    got = df.orderBy("date").toPandas()
    position, cash, held, value = 0, 1000.0, 0.0, [1000.0]
    positions, signals = [0], [0]
    for i in range(1, 400):
        value.append(held * price[i] if position else cash)
        signal = 0
        if z[i - 1] <= s.long_level < z[i] and not position:
            signal, position, held, cash = 1, 1, cash / price[i], 0.0
        elif z[i - 1] >= s.short_level > z[i] and position:
            signal, position, cash, held = -1, 0, held * price[i], 0.0
        positions.append(position)
        signals.append(signal)
    assert got.position.tolist() == positions and got.signal.tolist() == signals
    assert 1 in signals and -1 in signals
    np.testing.assert_allclose(got.portfolio_value, value)
    np.testing.assert_allclose(got.buy_hold_value, 1000 / price[0] * price)
    trades = [x for x in signals if x]
    assert all(a == -b for a, b in zip(trades, trades[1:]))


def test_interpolation_edges(spark):
    df = spark.createDataFrame([
        (dt.date(2020, 1, 1), None), (dt.date(2020, 1, 2), 1.0), (dt.date(2020, 1, 3), None),
        (dt.date(2020, 1, 6), 5.0), (dt.date(2020, 1, 7), None),
    ], "date date, v double")
    got = [r.v for r in st.interpolate(df, ["v"], st.Settings()).orderBy("date").collect()]
    assert got == [None, 1.0, 2.0, 5.0, 5.0]


@pytest.mark.parametrize("kind", ["SMA", "EMA", "DEMA", "WMA", "odd"])
def test_moving_averages_against_pandas(spark, kind):
    x = pd.Series(np.random.default_rng(1).normal(10, 1, 60))
    got = st.moving_average(series(spark, v=x), "v", "ma", kind, 12, st.Settings()).orderBy("date").toPandas().ma
    e1 = x.ewm(span=12, adjust=False).mean()
    weights = np.arange(1, 13)
    want = {
        "EMA": e1, "DEMA": 2 * e1 - e1.ewm(span=12, adjust=False).mean(),
        "WMA": x.rolling(12).apply(lambda v: (weights * v).sum() / weights.sum(), raw=True),
    }.get(kind, x.rolling(12).mean())
    np.testing.assert_allclose(got.astype(float), want, rtol=1e-9)


def test_combined_scores(spark):
    df = spark.createDataFrame([(1.0, 3.0), (-1.0, 3.0), (None, 3.0)], "a double, b double")
    score = lambda m: [r[0] for r in df.select(st.combined_score(m, F.col("a"), F.col("b"), 3, 1)).collect()]
    assert score("average") == [2.0, 1.0, None] == score("unknown")
    assert score("weighted") == [1.5, 0.0, None]
    assert score("consensus") == [2.0, 0.0, 0.0]      # a missing input counts as no consensus


def test_thirty_row_return_spans_29_steps(spark):
    s = st.Settings(capital=100.0)
    frame = lambda n: st.report(st.equity(st.signals(series(
        spark, combined_zscore=[0.0] * n, close=[float(100 + i) for i in range(n)],
        mvrv_zscore=[0.0] * n, nupl_zscore=[0.0] * n), s), s)).first()
    assert frame(31).market_month_return == pytest.approx((130 / 101 - 1) * 100)
    assert frame(30).market_month_return == 0 and frame(31).current_signal == "HOLD FIAT"


def test_labels(spark):
    scores = [-0.6, -0.59, -0.1, -0.09, 0.09, 0.1, 0.59, 0.6, None]
    df = spark.createDataFrame([(x,) for x in scores], "s double")
    got = [r[0] for r in df.select(sentiment_label(F.col("s"))).collect()]
    assert got == ["EXTREMELY FEAR", "FEAR", "FEAR", "NEUTRAL", "NEUTRAL", "GREED", "GREED",
                   "EXTREMELY GREED", "EXTREMELY GREED"]
    values = spark.createDataFrame([(float(x),) for x in (24, 25, 45, 56, 76)], "v double")
    got = [r[0] for r in values.select(index_label(F.col("v"))).collect()]
    assert got == ["EXTREME FEAR", "FEAR", "NEUTRAL", "GREED", "EXTREME GREED"]


def test_lexicon_counts_whole_words(spark):
    df = spark.createDataFrame([("The theory of and",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(lexicon_score(F.col("t"))).collect()]
    assert got[0] == pytest.approx(1 / 3) and got[1] == 0.0


def articles(spark, ids, hour):
    rows = [(i, 1_704_067_200 + hour * 3600 + i, "t", "s", "the the of" if i % 2 else "of", "u", 1, 0) for i in ids]
    return spark.createDataFrame(rows, inc.NEWS_SCHEMA)


def test_aligned_refresh_keeps_the_oldest_bucket_whole(spark):
    rows = score_news(articles(spark, range(60), 0))
    as_of = F.to_timestamp(F.lit("2024-01-02 00:00:30"))     # 24 hours back is 30 s into the bucket
    stored = fg.hourly_index(rows)
    assert fg.refresh_hourly(stored, rows, as_of).first().total_articles == 60
    assert fg.refresh_hourly(stored, rows, as_of, strict=True).first().total_articles == 30


def test_stream_equals_batch_and_takes_late_rows(spark, tmp_path):
    landed, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    drops = [articles(spark, range(10), 5), articles(spark, range(10, 14), 4)]     # the second is late
    for drop in drops:
        drop.write.mode("append").parquet(landed)
        inc.maintain_index(score_news(inc.news_stream(spark, landed)), "hour", out, state).awaitTermination()
    got = {str(r.bucket_start): r.total_articles for r in inc.current_buckets(spark, out).collect()}
    assert got == {"2024-01-01 05:00:00": 10, "2024-01-01 04:00:00": 4}
    late = articles(spark, range(20, 23), 5)
    late.write.mode("append").parquet(landed)
    inc.maintain_index(score_news(inc.news_stream(spark, landed)), "hour", out, state).awaitTermination()
    streamed = {str(r.bucket_start): (r.total_articles, round(r.fng_index_value, 6)) for r in inc.current_buckets(spark, out).collect()}
    everything = drops[0].unionByName(drops[1]).unionByName(late)
    batch = {str(r.hour_start): (r.total_articles, round(r.fng_index_value, 6)) for r in fg.hourly_index(score_news(everything)).collect()}
    assert streamed == batch


def test_scored_stream_takes_each_article_once(spark, tmp_path):
    landed, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for part in (range(5), range(5, 9)):
        articles(spark, part, 1).write.mode("append").parquet(landed)
        inc.append_scores(inc.news_stream(spark, landed), out, state).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(9))


def test_day_without_previous_has_no_change(spark):
    daily = fg.daily_index(score_news(articles(spark, range(4), 0).unionByName(articles(spark, range(4, 6), 24))))
    first, second = daily.orderBy("date").collect()
    assert first.fng_index_change is None and second.fng_index_change is not None


def test_merged_partials_count_each_batch_once(spark, tmp_path):
    """Several turns of the folders; repeated batches and late articles change nothing else."""
    landed, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    everything = None
    for i in range(7):
        drop = articles(spark, range(10 * i, 10 * i + 10), i % 3)
        everything = drop if everything is None else everything.unionByName(drop)
        drop.write.mode("append").parquet(landed)
        inc.maintain_index(score_news(inc.news_stream(spark, landed)), "day", out, state, slots=2).awaitTermination()
        if i == 5:  # it has merged all six; if it ran again it would merge the same rows
            assert inc.merged_partials(inc._kept_partials(spark, out, 5, 0)).first()["n"] == 60
    assert len(list((tmp_path / "out" / "batches").iterdir())) == 2 and len(list((tmp_path / "out" / "merged").iterdir())) == 2
    got, want = inc.current_buckets(spark, out).collect(), fg.daily_stats(score_news(everything)).collect()
    assert len(got) == len(want) == 1
    for c in want[0].asDict():
        if c != "date":
            assert got[0][c] == (pytest.approx(want[0][c]) if isinstance(want[0][c], float) else want[0][c]), c
