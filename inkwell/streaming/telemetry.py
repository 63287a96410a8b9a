"""Streams: windowed telemetry with watermarks, duplicate deliveries, first-token latencies."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def windowed(events: DataFrame, width: str = "1 hour", late: str = "30 minutes") -> DataFrame:
    """Counts and mean values a type and window; rows later than ``late`` are dropped with their window's state."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return e.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.avg("value").alias("mean")).select(F.col("w.start").alias("started"), "event_type", "n", "mean")


def once(rows: DataFrame, key: str, time: str, late: str = "1 day") -> DataFrame:
    """Each key once within the watermark, however often it is delivered; the state is dropped behind it."""
    return rows.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


LATENCY = "request_id string, first_event double, first_content double, last_event double, events long, tokens long, done boolean"


def latencies(events: DataFrame, idle: str = "10 minutes") -> DataFrame:
    """Per request the seconds of its first event, first content and last event, and its token count; one row when the request
    says done or has been idle. events: request_id, ts (timestamp), kind (event, content, done), tokens."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, content, last, n, tokens, done = state.get if state.exists else (None, None, None, 0, 0, False)
        if not state.hasTimedOut:
            for b in batches:
                t = b["ts"].astype("int64") / 1e9
                first = float(min(t.min(), first if first is not None else t.min()))
                last = float(max(t.max(), last if last is not None else t.max()))
                c = t[b["kind"] == "content"]
                if len(c):
                    content = float(min(c.min(), content if content is not None else c.min()))
                n, tokens = n + len(b), tokens + int(b["tokens"].fillna(0).sum())
                done = done or bool((b["kind"] == "done").any())
        if done or state.hasTimedOut:
            state.remove()
            yield pd.DataFrame([(key[0], first, content, last, n, tokens, done)], columns=["request_id", "first_event", "first_content", "last_event", "events", "tokens", "done"])
        else:
            state.update((first, content, last, n, tokens, done))
            state.setTimeoutTimestamp(int(max(state.getCurrentWatermarkMs(), int(last * 1000)) + pd.Timedelta(idle).value // 1_000_000))

    e = events.withWatermark("ts", idle)
    return e.groupBy("request_id").applyInPandasWithState(step, LATENCY, "first double, content double, last double, n long, tokens long, done boolean", "append", GroupStateTimeout.EventTimeTimeout)


def sentence_batches(rows: DataFrame, key: str, text: str, most: int = 8) -> DataFrame:
    """(key, batch, sentences): each text's sentences in batches of at most ``most``, in order; works on streams and tables."""
    from inkwell.functions.text import sentences

    s = rows.select(key, sentences(F.col(text)).alias("s")).where(F.size("s") > 0)
    starts = F.sequence(F.lit(0), F.floor((F.size("s") - 1) / most).cast("int"))
    return s.select(key, "s", F.explode(starts).alias("batch")).select(key, "batch", F.expr(f"slice(s, batch * {most} + 1, {most})").alias("sentences"))


def keyed_sink(stream: DataFrame, path: str, keys: list[str], checkpoint: str):
    """Starts a query that adds each micro-batch's new keys to the parquet table at ``path``. A batch delivered again after a
    failure adds nothing, as its keys are there."""
    from inkwell.sources.files import write_new

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, _: write_new(df, path, keys)).start()
