"""Keyed stream state: the latest row and running totals of each entity, which expire when it is silent.

An entity's *life* is a run of its events no more than ``expiry`` apart. The state store holds the current life
of each entity: its first and last time, its latest row, counts and sums. A timer on event time ends it when the
watermark has passed its last event by ``expiry``; a later event starts anew. Each trigger writes the lives it
touched to a folder of its own, replaced if the trigger runs again, and ``lives`` reads the last state of each.

The lives of many entities stand in one entry of the store, a bucket by the entity's hash: a call of Python and a state that
is read and written cost milliseconds, so they are paid once for each bucket and trigger, and an entity costs microseconds.
Each life keeps a timer of its own in its bucket, whose timer is the earliest of them.

Before the shuffle, events of one entity in an Arrow batch are combined into runs, so an entity that has most of
the events sends a row a batch and not a row an event. A run is part of one life whatever other tasks hold.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from strata.operators.asof import micros
from strata.streaming.windows import END_MICROS, state_in

# workers get this module's functions with the query: nothing has to be installed on them
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RUN = "entity long, first long, last long, last_id long, last_type string, n long, cents long"
LIFE = "entity long, life long, first long, last long, last_id long, last_type string, n long, cents long, closed boolean"
STATE = "lives binary"  # the current lives of a bucket as an Arrow table of HELD

#: Entries of the store that the entities are dealt out to, the same for the life of a checkpoint.
BUCKETS = 256
HELD = pa.schema([("entity", pa.int64()), ("timer", pa.int64()), ("life", pa.int64()), ("first", pa.int64()), ("last", pa.int64()),
                  ("last_id", pa.int64()), ("last_type", pa.string()), ("n", pa.int64()), ("cents", pa.int64())])


def combine_runs(ev: pd.DataFrame, expiry: int) -> pd.DataFrame:
    """Events (entity, at, id, type, cents) as runs of one entity with no gap over ``expiry`` (``RUN``)."""
    ev = ev.sort_values(["entity", "at", "id"], kind="stable", na_position="first", ignore_index=True)
    e, at = ev["entity"].to_numpy(), ev["at"].to_numpy()
    new = np.ones(len(ev), dtype=bool)
    new[1:] = (e[1:] != e[:-1]) | (at[1:] - at[:-1] > expiry)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(ev)) - 1
    return pd.DataFrame({
        "entity": e[first], "first": at[first], "last": at[last], "last_id": ev["id"].to_numpy()[last],
        "last_type": ev["type"].to_numpy()[last], "n": last - first + 1,
        "cents": np.add.reduceat(ev["cents"].to_numpy(), first) if len(ev) else []})


def merge(life: list, run: tuple) -> list:
    """A life (first, last, last_id, last_type, n, cents) with a run of it."""
    newer = (run[1], run[2]) > (life[1], life[2])
    return [min(life[0], run[0]), max(life[1], run[1]), *(run[2:4] if newer else life[2:4]), life[4] + run[4], life[5] + run[5]]


def fold(life: list | None, runs: list[tuple], expiry: int) -> tuple[list[list], list | None]:
    """Runs added to the current life, in the order of their time: (lives that ended, the current one)."""
    ended = []
    for run in sorted(runs):
        if life is None:
            life = list(run)
        elif run[0] - life[1] > expiry:
            ended.append(life)
            life = list(run)
        elif life[0] - run[1] > expiry:  # out of order by more than a life: one of its own
            ended.append(list(run))
        else:
            life = merge(life, run)
    return ended, life


def _runs(stream: DataFrame, entity: str, ts: str, event_id: str, kind: str, value: str, expiry: int) -> DataFrame:
    at = micros(F.col(ts), stream.schema[ts].dataType)
    cents = F.coalesce(F.round(F.col(value) * 100).cast("bigint"), F.lit(0).cast("bigint"))
    events = stream.where(F.col(ts).isNotNull() & (F.col(entity).isNotNull() | (at >= END_MICROS))).select(
        F.coalesce(F.col(entity).cast("bigint"), F.lit(-(1 << 63))).alias("entity"), at.alias("at"),
        F.coalesce(F.col(event_id).cast("bigint"), F.lit(-1)).alias("id"), F.col(kind).cast("string").alias("type"),
        cents.alias("cents"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("entity", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("last_id", pa.int64()),
                            ("last_type", pa.string()), ("n", pa.int64()), ("cents", pa.int64())])
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_pandas(combine_runs(b.to_pandas(), expiry), schema=schema, preserve_index=False)

    return events.mapInArrow(run, RUN).withColumn("last_ts", F.timestamp_micros("last"))


def _packed(held: dict[int, tuple]) -> bytes:
    """Lives by entity, (timer, life, first, last, last_id, last_type, n, cents), as bytes."""
    columns = zip(*[(entity, *life) for entity, life in held.items()], strict=True)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, HELD) as out:
        out.write_table(pa.table([pa.array(c, f.type) for c, f in zip(columns, HELD, strict=True)], schema=HELD))
    return sink.getvalue().to_pybytes()


def _unpacked(held: bytes) -> dict[int, tuple]:
    columns = [c.to_pylist() for c in pa.ipc.open_stream(held).read_all().columns]
    return {entity: life for entity, *life in zip(*columns, strict=True)}


def step_entity(held: tuple | None, runs: list[tuple], expiry: int) -> tuple[list[tuple], tuple]:
    """An entity's state (life, first, last, last_id, last_type, n, cents) after a trigger's runs: (rows for the output, state)."""
    own, before = (held[0], list(held[1:])) if held else (None, None)
    ended, life = fold(before, runs, expiry)
    rows = []
    for x in ended:
        same = before is not None and own is not None and x[0] <= own <= x[1]
        rows.append((own if same else x[0], *x, True))
    if own is None or not life[0] <= own <= life[1]:
        own = life[0]
    rows.append((own, *life, False))
    return rows, (own, *life)


def keep_lives(stream: DataFrame, entity: str, ts: str, event_id: str, kind: str, value: str, expiry_seconds: int,
               delay: str, buckets: int = BUCKETS) -> DataFrame:
    """A stream of the lives that each trigger touched (``LIFE``; times in microseconds, ``life`` names a life by the first
    time it was seen with). Rows without entity or time are left out, a NULL value adds 0."""
    expiry, nobody = expiry_seconds * 1_000_000, -(1 << 63)

    def step(key, frames, state):
        held = _unpacked(state.get[0]) if state.exists else {}
        now, rows, touched = state.getCurrentWatermarkMs(), [], {}
        if not state.hasTimedOut:
            for f in frames:
                for e, *run in f[["entity", "first", "last", "last_id", "last_type", "n", "cents"]].itertuples(index=False, name=None):
                    if e != nobody:  # the row that ends a stream has moved the watermark
                        touched.setdefault(e, []).append(tuple(run))
        for e, runs in touched.items():
            out, life = step_entity(held[e][1:] if e in held else None, runs, expiry)
            rows += [(e, *r) for r in out]
            held[e] = (max((life[2] + expiry) // 1000 + 1, now + 1), *life)
        for e in [e for e, x in held.items() if x[0] < now and e not in touched]:
            rows.append((e, *held.pop(e)[1:], True))
        if held:
            state.update((_packed(held),))
            state.setTimeoutTimestamp(max(min(x[0] for x in held.values()), now + 1))
        elif state.exists:
            state.remove()
        if rows:
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in LIFE.split(", ")])

    runs = _runs(stream, entity, ts, event_id, kind, value, expiry).withWatermark("last_ts", delay)
    bucket = F.pmod(F.xxhash64("entity"), F.lit(buckets)).cast("int")
    return runs.withColumn("bucket", bucket).groupBy("bucket").applyInPandasWithState(
        step, LIFE, STATE, "update", GroupStateTimeout.EventTimeTimeout)


def start_lives(spark: SparkSession, source_dir: str, schema: T.StructType, table_path: str, checkpoint: str,
                files_per_trigger: int = 1, partitions: int | None = None, **columns) -> StreamingQuery:
    """Read what is in ``source_dir``, some files a trigger, and write the lives that each trigger touched."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source_dir)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table_path}/trigger={number}")

    with state_in(spark, partitions):
        return (keep_lives(stream, **columns).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
                .outputMode("update").trigger(availableNow=True).start())


def lives(spark: SparkSession, table_path: str) -> DataFrame:
    """The last state of each life, from what the triggers wrote."""
    rows = spark.read.schema(LIFE + ", trigger long").parquet(table_path)
    last = Window.partitionBy("entity", "life").orderBy(F.desc("trigger"), F.desc("n"))
    return rows.withColumn("k", F.row_number().over(last)).where("k = 1").drop("k", "trigger")
