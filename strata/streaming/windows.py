"""Event-time windows as a stream: tumbling, sliding and session windows, with a watermark and late rows counted.

The stream drops repeated events (a state of the ids inside the watermark) and rows that come after the watermark
has passed their time, then aggregates into windows and writes each window once, when the watermark has passed
its end, to a Parquet table. Both steps keep their state in the state store and the stream's progress in its
checkpoint, so a stream that stops goes on where it was. ``windowed`` alone is the same aggregation in batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.operators.asof import micros

#: The event time of the row that ends a stream: later than any event (and a time that pandas can hold), in no window.
END_OF_STREAM, END_MICROS = "2200-01-01 00:00:00", 7_258_118_400_000_000


def windowed(events: DataFrame, ts: str, by: Sequence[str] = (), width: str | None = None, slide: str | None = None,
             gap: str | None = None, value: str | None = None) -> DataFrame:
    """Rows and the sum of ``value`` (as an exact decimal) for each ``by`` and window of ``width``, every ``slide`` (default:
    ``width``), or for each session: rows no more than ``gap`` apart. Rows with a NULL time are in no window."""
    w = F.session_window(ts, gap) if gap else F.window(ts, width, slide or width)
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        aggs.append(F.sum(F.col(value).try_cast("decimal(18,2)")).alias("total"))
    out = events.groupBy(*by, w.alias("w")).agg(*aggs)
    return out.select(*by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      *[F.col(c) for c in ("n", "total") if c in out.columns])


def on_time(events: DataFrame, ts: str, delay: str, event_id: str) -> DataFrame:
    """A stream's events once each, without those that the watermark (``delay`` behind the latest time) has passed.

    A watermark needs a TIMESTAMP: a time without zone is taken as one of UTC, whatever the session's zone is.
    """
    if isinstance(events.schema[ts].dataType, T.TimestampNTZType):
        events = events.withColumn(ts, F.timestamp_micros(micros(F.col(ts), T.TimestampNTZType())))
    marked = events.where(F.col(ts).isNotNull()).withWatermark(ts, delay).dropDuplicates([event_id, ts])
    # after the watermark, as the last row has to move it; the time in it keeps the filter there
    return marked.where(F.unix_micros(ts) < END_MICROS)


def without_zone(c: str) -> Column:
    """The UTC clock's time of a TIMESTAMP."""
    seconds = (F.unix_micros(c).cast("decimal(24,0)") / 1_000_000).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


@contextmanager
def state_in(spark: SparkSession, partitions: int | None) -> Iterator[None]:
    """A query started here keeps its state in so many partitions (default: the session's shuffle partitions), for the
    life of its checkpoint. The stream takes the setting over as it starts; the session has its own again after."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    try:
        if partitions:
            spark.conf.set(name, str(partitions))
        yield
    finally:
        spark.conf.set(name, before)


def start_windows(spark: SparkSession, source_dir: str, schema: T.StructType, table_path: str, checkpoint: str, ts: str,
                  event_id: str, delay: str, files_per_trigger: int = 1, partitions: int | None = None, **window) -> StreamingQuery:
    """Read what is in ``source_dir``, some files a trigger, and append each closed window to ``table_path``."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source_dir))
    out = windowed(on_time(stream, ts, delay, event_id), ts, **window)
    if isinstance(schema[ts].dataType, T.TimestampNTZType):
        out = out.withColumns({c: without_zone(c) for c in ("window_start", "window_end")})
    with state_in(spark, partitions):
        return (out.writeStream.format("parquet").option("path", table_path).option("checkpointLocation", checkpoint)
                .outputMode("append").trigger(availableNow=True).start())


def end_stream(spark: SparkSession, source_dir: str, schema: T.StructType, ts: str) -> None:
    """Add the row that closes all windows: nothing but a time later than any event's."""
    end = (F.lit(END_OF_STREAM).cast("timestamp_ntz") if isinstance(schema[ts].dataType, T.TimestampNTZType)
           else F.timestamp_micros(F.lit(END_MICROS)))
    cols = [end.alias(ts) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    spark.range(1).select(*cols).coalesce(1).write.mode("append").parquet(source_dir)


def late_rows(query: StreamingQuery) -> int:
    """Rows that came too late, over the triggers that the query's progress remembers (the session's
    ``spark.sql.streaming.numRecentProgressUpdates``, 100 unless set)."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"]
               if op["operatorName"] == "dedupe")
