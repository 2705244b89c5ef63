"""Structured Streaming forms: news change stream, rolling indexes, delta indicators."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidegauge.functions.labels import Scorer, index_label, index_value, lexicon_score
from tidegauge.operators.keyed import latest_rows, upsert
from tidegauge.operators.frames import BASE, add_frames, inputs_of
from tidegauge.operators.recursive import (
    OUTPUTS, PASSED, Plan, add_recursive, closing_states, segment_ends, starting_states,
)
from tidegauge.operators.segments import ROWS_PER_SEGMENT, TAIL, Segmented, drop_halo, resume, segment
from tidegauge.plans.fear_greed import score_news, stamped
from tidegauge.plans.indicators import indicators
from tidegauge.session import cut_lineage
from tidegauge.sources.snapshots import SnapshotTable, by_month

NEWS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("published_on", T.LongType()),
    T.StructField("title", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("body", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("upvotes", T.LongType()), T.StructField("downvotes", T.LongType()),
])


def news_stream(spark: SparkSession, path: str) -> DataFrame:
    """Rows appended to the news folder."""
    return spark.readStream.schema(NEWS_SCHEMA).parquet(path)


def append_scores(
    news: DataFrame, out: str, checkpoint: str, scorer: Scorer = lexicon_score,
    every: str | None = None,
) -> StreamingQuery:
    """Score new articles into ``out``, once each, with the time of their batch; ``every`` runs on
    an interval, otherwise whatever has arrived is processed and the query ends."""
    writer = (
        stamped(score_news(news, scorer)).writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


#: Batches whose partial aggregates are kept apart before they are merged into one.
SLOTS = 16


def bucket_partials(scored: DataFrame, unit: str) -> DataFrame:
    """What scored articles add to their hour or day: counts, sums and extremes, which can be merged."""
    score, label = F.col("sentiment_score"), F.col("sentiment_label")
    return scored.groupBy(F.date_trunc(unit, "published_datetime").alias("bucket_start")).agg(
        F.count(F.lit(1)).alias("n"), F.count(score).alias("n_scores"),
        F.sum(score).alias("total"), F.sum(score * score).alias("squares"), F.min(score).alias("least"), F.max(score).alias("most"),
        F.count_if(label.isin("GREED", "EXTREMELY GREED")).alias("positive"), F.count_if(label == "NEUTRAL").alias("neutral"),
        F.count_if(label.isin("FEAR", "EXTREMELY FEAR")).alias("negative"),
    )


PARTIALS = ("bucket_start timestamp, n long, n_scores long, total double, squares double, least double, most double, "
            "positive long, neutral long, negative long, upto long")


def merged_partials(parts: DataFrame) -> DataFrame:
    sums = ("n", "n_scores", "total", "squares", "positive", "neutral", "negative")
    return parts.groupBy("bucket_start").agg(*(F.sum(c).alias(c) for c in sums), F.min("least").alias("least"), F.max("most").alias("most"))


def index_of_partials(parts: DataFrame) -> DataFrame:
    """The hourly or daily index with the statistics of its scores, from merged partial aggregates."""
    n, mean = F.col("n_scores"), F.col("total") / F.col("n_scores")
    spread = F.greatest(F.col("squares") - F.col("total") * mean, F.lit(0.0))
    rows = merged_partials(parts).select(
        "bucket_start", F.col("n").alias("total_articles"), F.col("positive").alias("positive_articles"),
        F.col("neutral").alias("neutral_articles"), F.col("negative").alias("negative_articles"), mean.alias("avg_sentiment_score"),
        F.col("least").alias("min_sentiment_score"), F.col("most").alias("max_sentiment_score"),
        F.when(n > 1, F.sqrt(spread / (n - 1))).alias("stddev_sentiment_score"),
    )
    return rows.withColumn("fng_index_value", index_value(F.col("avg_sentiment_score"))).withColumn(
        "fng_index_label", index_label(F.col("fng_index_value"))
    )


def _kept_partials(spark: SparkSession, out: str, number: int | None = None, side: int | None = None) -> DataFrame:
    """The newest merged partials and those of later batches; for merging anew, without the
    side that is about to be written and up to batch ``number``."""
    names = [c.split()[0] for c in PARTIALS.split(", ")]

    def read(name: str) -> DataFrame:
        try:
            return spark.read.schema(PARTIALS).parquet(f"{out}/{name}")
        except AnalysisException:  # nothing written yet
            return spark.createDataFrame([], f"{PARTIALS}, side int, slot int")

    merged, single = read("merged"), read("batches")
    if number is not None:
        merged, single = merged.filter(F.col("side") != side), single.filter(F.col("upto") <= number)
    newest = merged.agg(F.coalesce(F.max("upto"), F.lit(-1)).alias("_newest"))  # one row
    rows = merged.join(F.broadcast(newest), F.col("upto") == F.col("_newest")).select(*names)
    later = single.join(F.broadcast(newest), F.col("upto") > F.col("_newest")).select(*names)
    return rows.unionByName(later)


def maintain_index(
    scored: DataFrame, unit: str, out: str, checkpoint: str, every: str | None = None, slots: int = SLOTS
) -> StreamingQuery:
    """Keep mergeable aggregates per hour or day; no stored article is ever read again.

    However late an article is, its batch adds to its bucket.  A batch writes the aggregates
    of its own articles into one of ``slots`` folders in turn; the last of a turn merges them
    all into one of two further folders, so the number of folders does not grow.  A repeated
    batch rewrites its own folder, and the merged rows say up to which batch they go, so
    nothing counts twice.  :func:`current_buckets` reads between batches.
    """
    spark = scored.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        own = bucket_partials(batch, unit).withColumn("upto", F.lit(number).cast("long"))
        own.write.mode("overwrite").parquet(f"{out}/batches/slot={number % slots}")
        if number % slots == slots - 1:
            side = number // slots % 2
            kept = merged_partials(_kept_partials(spark, out, number, side)).withColumn("upto", F.lit(number).cast("long"))
            kept.write.mode("overwrite").parquet(f"{out}/merged/side={side}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        scored.writeStream.outputMode("append").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def current_buckets(spark: SparkSession, out: str) -> DataFrame:
    return index_of_partials(_kept_partials(spark, out))


# newest bars per symbol that a later delivery may repeat or correct
REDO = 200


@dataclass(frozen=True)
class Progress:
    """What a delta run needs of earlier bars, bounded per symbol whatever the length
    of the history: the ``REDO`` newest bars, the rows before them, and the states
    between the two, so that the newest bars can be computed anew."""

    tail: DataFrame
    recent: DataFrame
    states: DataFrame


def recursive_inputs(columns: list[str]) -> list[str]:
    return [c for c in OUTPUTS if c in inputs_of(columns)]


def _set_apart(bars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All but the ``REDO`` newest bars per symbol, and those."""
    newest = Window.partitionBy("symbol").orderBy(F.col("unix_timestamp").desc())
    ranked = bars.withColumn("_age", F.row_number().over(newest))
    return ranked.filter(F.col("_age") > REDO).drop("_age"), ranked.filter(F.col("_age") <= REDO).drop("_age")


def first_run(bars: DataFrame, columns: list[str]) -> tuple[DataFrame, Progress]:
    """Full indicator table and the progress behind its last bar."""
    bars = bars.select(*[c for c in bars.columns if c in BASE])
    recent = latest_rows(bars, "unix_timestamp", REDO, ["symbol"])
    older = bars.join(recent.select("symbol", "unix_timestamp"), ["symbol", "unix_timestamp"], "left_anti")
    states = closing_states(segment(older), recursive_inputs(columns))
    tail = latest_rows(older, "unix_timestamp", TAIL, ["symbol"])
    return indicators(bars, columns), Progress(tail, recent, states)


def _continued(tail: DataFrame, rows: DataFrame, states: DataFrame, wanted: list[str], rows_per_segment: int, named: bool = False):
    """Bars behind kept ones as segments, and the starting state of every later segment
    (with the inputs' names between the two if ``named``)."""
    slices = resume(tail, rows, states, rows_per_segment)
    starts = None
    if wanted:
        slices = replace(slices, df=cut_lineage(slices.df))
        starts = starting_states(Plan.of(wanted, rows_per_segment), slices.df.select(*PASSED), states)
    return (slices, wanted, starts) if named else (slices, starts)


def _published(slices: Segmented, starts: DataFrame | None, columns: list[str], new: DataFrame) -> DataFrame:
    """Indicator rows from the first new bar of each symbol on."""
    wanted = recursive_inputs(columns)
    df = add_recursive(slices, wanted, starts) if wanted else slices.df
    first = new.groupBy("symbol").agg(F.min("unix_timestamp").alias("_first"))
    return drop_halo(add_frames(df, columns)).join(first, "symbol").filter(
        F.col("unix_timestamp") >= F.col("_first")
    ).select(*[c for c in new.columns if c in BASE], *columns)


def next_run(
    progress: Progress, new: DataFrame, columns: list[str], rows_per_segment: int = ROWS_PER_SEGMENT
) -> tuple[DataFrame, Progress]:
    """Indicator rows from the first delivered bar of each symbol on, equal to those
    of a full run.

    Delivered bars, however many, replace known ones of the same time and may fill gaps between
    them, up to ``REDO`` bars back; an older one fails the run, as it needs the stored bars
    (:func:`restarted_run`).  Reads the new bars and the bounded progress, never the history.
    """
    key = ["symbol", "unix_timestamp"]
    new = new.select(*progress.tail.columns)
    settled = progress.tail.groupBy("symbol").agg(F.max("unix_timestamp").alias("_settled"))
    late = F.raise_error(F.concat(F.lit("bar too old for a delta run: "), F.col("symbol")))
    fresh = new.join(settled, "symbol", "left").withColumn("unix_timestamp", F.when(
        F.col("unix_timestamp") <= F.col("_settled"), late.cast("long")
    ).otherwise(F.col("unix_timestamp"))).select(*new.columns)
    redone = progress.recent.join(new.select(*key), key, "left_anti").select(*new.columns).unionByName(fresh)
    wanted = recursive_inputs(columns)
    slices, starts = _continued(progress.tail, redone, progress.states, wanted, rows_per_segment)
    rows = _published(slices, starts, columns, new)

    done, recent = _set_apart(redone)
    # a symbol of which no bar is done keeps its state
    moved = closing_states(*_continued(progress.tail, done, progress.states, wanted, rows_per_segment, True))
    states = moved.unionByName(progress.states.join(moved, "symbol", "left_anti"))
    tail = latest_rows(progress.tail.unionByName(done), "unix_timestamp", TAIL, ["symbol"])
    return rows, Progress(tail, recent, states)


def delta_indicators(
    stored: DataFrame, progress: Progress, new: DataFrame, columns: list[str]
) -> tuple[DataFrame, Progress]:
    """Upsert of the rows of new bars into the stored indicator table."""
    rows, progress = next_run(progress, new, columns)
    return upsert(stored, rows, ["symbol", "unix_timestamp"], checked=False), progress


LOG = "symbol string, since long, until long, carry array<double>, state array<double>"


def logged_run(bars: DataFrame, columns: list[str], rows_per_segment: int = ROWS_PER_SEGMENT) -> tuple[DataFrame, DataFrame]:
    """Full indicator table and the log of states: one row per completed segment of a symbol,
    with the states behind its last bar (``until``) and the first bar that a run from there reads."""
    bars = bars.select(*[c for c in bars.columns if c in BASE])
    log = segment_ends(segment(bars, rows_per_segment), recursive_inputs(columns)).drop("_seg")
    return indicators(bars, columns, rows_per_segment), log


def restart_points(log: DataFrame, new: DataFrame) -> DataFrame:
    """Per symbol of ``new``: its first delivered bar and, if any, the last log row before that bar."""
    first = new.groupBy("symbol").agg(F.min("unix_timestamp").alias("_first"))
    row = F.struct("until", "since", "carry", "state")
    before = log.join(first, "symbol").filter(F.col("until") < F.col("_first")).groupBy("symbol").agg(F.max_by(row, "until").alias("_r"))
    return cut_lineage(first.join(before.select("symbol", "_r.*"), "symbol", "left"))


def restarted_run(
    stored: DataFrame, log: DataFrame, new: DataFrame, columns: list[str],
    rows_per_segment: int = ROWS_PER_SEGMENT, points: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Indicator rows from the first delivered bar of each symbol on, and the log, as of a full run.

    Delivered bars may lie at any depth and be any number.  Each symbol restarts behind the
    last log row before its first delivered bar, or at its beginning if there is none, and
    reads stored bars from ``since`` on only.  Symbols without new bars are not read.
    """
    new = new.select(*[c for c in new.columns if c in BASE])
    points = restart_points(log, new) if points is None else points
    key = ["symbol", "unix_timestamp"]
    known = stored.select(*new.columns).join(points.select("symbol", "since", "until"), "symbol")
    tail = known.filter((F.col("unix_timestamp") >= F.col("since")) & (F.col("unix_timestamp") <= F.col("until"))).select(*new.columns)
    later = known.filter(F.col("until").isNull() | (F.col("unix_timestamp") > F.col("until"))).select(*new.columns)
    redone = later.join(new.select(*key), key, "left_anti").unionByName(new)
    wanted = recursive_inputs(columns)
    states = points.filter("until IS NOT NULL").select("symbol", "carry", "state")
    slices, starts = _continued(tail, redone, states, wanted, rows_per_segment)
    kept = log.join(points.select("symbol", "_first"), "symbol", "left").filter(
        F.col("_first").isNull() | (F.col("until") < F.col("_first"))).drop("_first")
    ends = segment_ends(slices, wanted, starts).drop("_seg") if wanted else log.limit(0)
    return _published(slices, starts, columns, new), kept.unionByName(ends)


@dataclass(frozen=True)
class IndicatorStore:
    """Bars and indicator rows as merged tables, and the log of states of each version of the rows."""

    spark: SparkSession
    path: str
    columns: tuple[str, ...]
    rows_per_segment: int = ROWS_PER_SEGMENT

    def _table(self, name: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.path}/{name}", ("symbol", "unix_timestamp"), by_month("unix_timestamp"))

    @property
    def bars(self) -> SnapshotTable:
        return self._table("bars")

    @property
    def rows(self) -> SnapshotTable:
        return self._table("rows")

    def log(self, version: int) -> DataFrame:
        return self.spark.read.schema(LOG).parquet(f"{self.path}/log/version={version}")

    def _keep_log(self, log: DataFrame, version: int) -> None:
        log.select("symbol", "since", "until", "carry", "state").write.mode("overwrite").parquet(f"{self.path}/log/version={version}")

    def create(self, bars: DataFrame) -> None:
        self.bars.create(bars.select(*[c for c in bars.columns if c in BASE]))
        rows, log = logged_run(self.bars.read(1), list(self.columns), self.rows_per_segment)
        self._keep_log(log, 1)
        self.rows.create(rows)

    def deliver(self, new: DataFrame) -> DataFrame:
        """Takes new, late or corrected bars in; returns the indicator table as a full run would give it.

        Reads the months of stored bars from the restart points on and rewrites the months
        that change.  A delivery that died is to be delivered again.
        """
        new = cut_lineage(new.select(*[c for c in new.columns if c in BASE]))
        version = self.rows.versions()[-1]
        log = self.log(version)
        points = restart_points(log, new)
        whole, since = points.agg(F.bool_or(F.col("until").isNull()), F.min("since")).first()  # one row
        held, _ = self.bars.holders()
        months = None
        if whole is False:
            first = datetime.fromtimestamp(since, timezone.utc).strftime("%Y-%m")
            months = [m for m in held if m >= first]
        stored = self.bars.read(parts=months)
        self.bars.merge(new)
        rows, log = restarted_run(stored, log, new, list(self.columns), self.rows_per_segment, points)
        self._keep_log(log, version + 1)
        self.rows.merge(rows)
        return self.rows.read()


def restarted_indicators(
    stored: DataFrame, bars: DataFrame, columns: list[str], warmup_rows: int = 1000
) -> DataFrame:
    """The simple delta: recompute on the newest rows and keep those above the
    stored maximum.  Recursive and cumulative columns restart at the first of
    those rows, so they differ from a full run."""
    fresh = indicators(latest_rows(bars, "unix_timestamp", warmup_rows, ["symbol"]), columns)
    marks = stored.groupBy("symbol").agg(F.max("unix_timestamp").alias("_mark"))
    newer = fresh.join(marks, "symbol", "left").filter(
        F.col("_mark").isNull() | (F.col("unix_timestamp") > F.col("_mark"))
    ).drop("_mark")
    return upsert(stored, newer, ["symbol", "unix_timestamp"], checked=False)
