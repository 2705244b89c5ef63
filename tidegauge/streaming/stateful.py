"""Recursive indicators as one stream: Spark keeps each symbol's state between batches and restarts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidegauge.operators.recursive import INTEGER_OUTPUTS, Plan, closing, finish
from tidegauge.operators.segments import HALO, ROWS_PER_SEGMENT, TAIL

BAR = ["unix_timestamp", "open", "high", "low", "close", "volume_btc", "volume_usd"]
BARS_SCHEMA = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("unix_timestamp", T.LongType()), *[
    T.StructField(c, T.DoubleType()) for c in BAR[1:]]])
#: Bars of a symbol that are worked on at once; a longer batch goes through in such pieces.
PIECE = ROWS_PER_SEGMENT

KEPT = T.StructType([
    T.StructField("unix_timestamp", T.ArrayType(T.LongType())),
    *[T.StructField(c, T.ArrayType(T.DoubleType())) for c in BAR[1:]],
    T.StructField("carry", T.ArrayType(T.DoubleType())), T.StructField("state", T.ArrayType(T.DoubleType())),
])


class RecursiveIndicators(StatefulProcessor):
    """Keeps a symbol's newest bars (TAIL at most) and, once it is long enough, the states behind them."""

    def __init__(self, columns: list[str]):
        self.plan = Plan.of(columns, ROWS_PER_SEGMENT)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", KEPT)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        symbol = key[0]
        new = pd.concat(list(rows), ignore_index=True)
        new = new.sort_values(BAR, kind="stable").drop_duplicates("unix_timestamp", keep="last")
        tail, carry, state = self._known()
        newest = tail["unix_timestamp"].iloc[-1] if len(tail) else None
        late = new["unix_timestamp"] <= newest if newest is not None else pd.Series(False, index=new.index)
        if late.any():
            yield self._shaped(symbol, new[late], None)
        new = new[~late]
        for at in range(0, len(new), PIECE):
            piece = new.iloc[at:at + PIECE]
            slices = self._slice(symbol, tail, piece, carry is not None)
            yield self._shaped(symbol, piece, finish(self.plan, slices, carry, state).tail(len(piece)))
            end = closing(self.plan, slices, carry, state)
            if len(end):
                carry, state = np.array(end["carry"].iloc[0]), np.array(end["state"].iloc[0])
            tail = pd.concat([tail, piece[BAR]]).tail(HALO if carry is not None else TAIL)
        if len(new):
            known = [list(v) if v is not None else None for v in (carry, state)]
            self.kept.update((*[tail[c].tolist() for c in BAR], *known))

    def close(self) -> None:
        pass

    def _known(self):
        if not self.kept.exists():
            return pd.DataFrame({c: pd.Series([], dtype="int64" if c == BAR[0] else float) for c in BAR}), None, None
        *columns, carry, state = self.kept.get()
        tail = pd.DataFrame(dict(zip(BAR, columns, strict=True)))
        return tail, *(np.array(v) if v is not None else None for v in (carry, state))

    def _slice(self, symbol: str, tail: pd.DataFrame, piece: pd.DataFrame, known: bool) -> pd.DataFrame:
        both = pd.concat([tail.assign(_halo=known), piece[BAR].assign(_halo=False)], ignore_index=True)
        return both.assign(symbol=symbol, _seg=int(known), _li=np.arange(len(both)))

    def _shaped(self, symbol: str, bars: pd.DataFrame, found: pd.DataFrame | None) -> pd.DataFrame:
        out = pd.DataFrame({"symbol": symbol, "unix_timestamp": bars["unix_timestamp"].to_numpy(), "late": found is None})
        for c in self.plan.columns:
            values = found[c].to_numpy(dtype=float) if found is not None else np.full(len(out), np.nan)
            if c in INTEGER_OUTPUTS:
                out[c] = pd.array(np.where(np.isnan(values), 0, values).astype("int32"), dtype="Int32")
                if found is None:
                    out[c] = pd.array([None] * len(out), dtype="Int32")
            else:
                out[c] = pd.Series(values).astype(object).where(~np.isnan(values), None)
        return out


def bar_stream(spark: SparkSession, path: str, files: int | None = None) -> DataFrame:
    """Bars appended to a folder; `files` bounds what one batch takes in."""
    reader = spark.readStream.schema(BARS_SCHEMA)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(path)


def indicator_stream(bars: DataFrame, columns: list[str]) -> DataFrame:
    """(symbol, unix_timestamp, late, columns) of streamed bars, for the recursive indicator columns.

    Each bar comes out once, with the values of a run over all bars of its symbol so far.  The
    state is a bounded number of bars and numbers per symbol.  A bar no newer than its symbol's
    newest comes out with ``late`` set and NULL values, so that it can be delivered to an
    :class:`~tidegauge.streaming.incremental.IndicatorStore`; so does every later batch's repeat.
    """
    schema = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("unix_timestamp", T.LongType()), T.StructField("late", T.BooleanType()), *[
        T.StructField(c, T.IntegerType() if c in INTEGER_OUTPUTS else T.DoubleType()) for c in columns]])
    return bars.groupBy("symbol").transformWithStateInPandas(
        statefulProcessor=RecursiveIndicators(list(columns)), outputStructType=schema, outputMode="Append", timeMode="None")


def keep_indicators(bars: DataFrame, columns: list[str], out: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Appends the indicator rows to ``out``; the states live in the checkpoint, so a restart goes on where it was."""
    conf = bars.sparkSession.conf
    conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    writer = indicator_stream(bars, columns).writeStream.format("parquet").outputMode("append")
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.option("path", out).option("checkpointLocation", checkpoint).trigger(**trigger).start()
