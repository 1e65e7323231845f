"""State of streams: keyed with an expiry, or a table of deltas and snapshots."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructType

from lawgrain.params import COMPLETED_STATUSES
from lawgrain.session import child_folders, path_exists, remove_path

# A month: a URI not listed for so long is as new.
EXPIRY_MS = 30 * 86_400_000
# Parts of the state of `until_done`.
BUCKETS = 1 << 13


def until_done(
    outcomes: DataFrame,
    expiry_ms: int = EXPIRY_MS,
    uri: str = "akn_uri",
    status: str = "status",
    order: str = "item_no",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Streaming form of `in_run_dedup`: per URI the rows up to the first success or skip.

    A URI that failed is tried again when it is listed again, in the same or a later
    micro-batch or after a restart; one that is done never is. The state holds, for each
    URI seen in the last `expiry_ms` (processing time), whether it is done and when it was
    seen; the batches drop older ones. So the state is bounded by the URIs of that span, and a
    URI that was not listed for so long counts as new. `order` must be unique per URI; rows
    are ordered by it within a micro-batch, and by arrival across them.

    URIs are dealt by their hash to `buckets`, and a bucket's URIs are worked off together:
    a call of the function costs milliseconds, one for each URI would be nearly all of the
    time. A bucket's state is one value, read and written whole when one of its URIs is
    listed, and it goes when none was for `expiry_ms`. Of the rows of a bucket in one
    micro-batch, those behind a completion are dropped as they come. A checkpoint goes with
    its number of buckets, and with this form of the state.

    The state is passed to the tasks with the rows, and the function is sent to them whole:
    neither the driver nor a task starts a process that has to import this module.

    Start it within `without_empty_batches`: Spark runs batches without data for as long as
    anything may expire, which `availableNow` would never end.
    """
    completing = tuple(COMPLETED_STATUSES)
    uri_type = to_arrow_type(outcomes.schema[uri].dataType)
    # pandas makes floats of a column of longs with a NULL: NULLs go beside it
    longs = {f.name: f"{f.name} is null" for f in outcomes.schema if f.dataType == LongType() and f.name != uri}
    no_order = longs.get(order)

    def up_to_first(rows: pd.DataFrame) -> pd.DataFrame:
        """Without the rows behind the first completion of their URI."""
        complete = rows[status].isin(completing).to_numpy()
        if not complete.any():
            return rows
        codes, _ = pd.factorize(rows[uri], use_na_sentinel=False)
        usable = ~(rows[no_order] if no_order else rows[order].isna()).to_numpy(bool)
        some = complete & usable
        first = rows.loc[some, order].groupby(codes[some]).min()
        at = first.index.get_indexer(codes)
        keep = ~np.isin(codes, codes[complete])
        known = usable & (at >= 0)
        keep[known] = rows.loc[known, order].to_numpy() <= first.to_numpy()[at[known]]
        return rows[keep]

    def up_to_first_done(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        now = int(state.getCurrentProcessingTimeMs())
        known, done, last_seen = pd.Index([], dtype=object), np.zeros(0, bool), np.zeros(0, np.int64)
        if state.exists:
            held = pa.ipc.open_stream(pa.py_buffer(state.get[0])).read_all()
            last_seen = held["last_seen"].to_numpy()
            # one listed again in the batch that would have removed it counts as new, too
            fresh = last_seen + expiry_ms > now
            known = pd.Index(held["uri"].to_pandas(), dtype=object)[fresh]
            done, last_seen = held["done"].to_numpy()[fresh], last_seen[fresh]
        listed, completed, kept, size, limit = [], [], [], 0, 1 << 16
        for frame in frames:
            listed.append(pd.unique(frame[uri]))
            frame = frame[~np.append(done, False)[known.get_indexer(frame[uri])]]
            completed.append(pd.unique(frame.loc[frame[status].isin(completing), uri]))
            kept.append(frame)
            size += len(frame)
            if size > limit:
                kept = [up_to_first(pd.concat(kept))]
                size, limit = len(kept[0]), max(limit, 2 * len(kept[0]))
        rows = up_to_first(pd.concat(kept))
        # renewed whenever the URI is seen, gone when it was not for `expiry_ms`
        listed = pd.unique(np.concatenate(listed))
        at = known.get_indexer(listed)
        known = known.append(pd.Index(listed[at < 0], dtype=object))
        done = np.append(done, np.zeros(len(known) - len(done), bool))
        done[known.get_indexer(np.concatenate(completed))] = True
        last_seen[at[at >= 0]] = now
        last_seen = np.append(last_seen, np.full(len(known) - len(last_seen), now))
        columns = [pa.array(known, uri_type, from_pandas=True), pa.array(done), pa.array(last_seen, pa.int64())]
        held = pa.RecordBatch.from_arrays(columns, names=["uri", "done", "last_seen"])
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, held.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
            writer.write_batch(held)
        state.update((out.getvalue().to_pybytes(),))
        state.setTimeoutDuration(expiry_ms)
        yield rows[names]

    sent = outcomes.select(
        *[F.coalesce(F.col(f.name), F.lit(0)).alias(f.name) if f.name in longs else F.col(f.name) for f in outcomes.schema],
        *[F.col(name).isNull().alias(null) for name, null in longs.items()],
    )
    names = sent.columns
    bucket = F.pmod(F.xxhash64(uri), F.lit(buckets))
    rows = sent.withColumn("bucket of the uri", bucket).groupBy("bucket of the uri").applyInPandasWithState(
        up_to_first_done,
        sent.schema,
        "seen binary",
        "append",
        GroupStateTimeout.ProcessingTimeTimeout,
    )
    return rows.select(*[F.when(~F.col(longs[n]), F.col(n)).alias(n) if n in longs else n for n in outcomes.columns])


@contextmanager
def without_empty_batches(spark: SparkSession) -> Iterator[None]:
    """Streams started inside run no batches without data; what expires goes with the next."""
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


# -- a state table ------------------------------------------------------------
# Each micro-batch adds a delta; every so many a snapshot holds all before it:
#   root/delta=<batch>/…      root/snapshot=<batch>/…


def _numbers(spark: SparkSession, root: str, kind: str) -> list[int]:
    """Batches with a complete folder of a kind."""
    names = [n for n in child_folders(spark, root) if n.startswith(f"{kind}=")]
    return sorted(int(n.split("=")[1]) for n in names if path_exists(spark, f"{root}/{n}/_SUCCESS"))


def state_folders(spark: SparkSession, root: str, batch_id: int) -> list[str]:
    """Folders with the state before a batch: the last snapshot and the deltas since."""
    snapshots = [n for n in _numbers(spark, root, "snapshot") if n < batch_id]
    last = max(snapshots, default=-1)
    deltas = [n for n in _numbers(spark, root, "delta") if last < n < batch_id]
    return [f"{root}/snapshot={n}" for n in snapshots[-1:]] + [f"{root}/delta={n}" for n in deltas]


def state_before(spark: SparkSession, root: str, schema: StructType, batch_id: int) -> DataFrame:
    """Rows of the state before a batch; what a lost try of the batch has left is not read."""
    folders = state_folders(spark, root, batch_id)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def add_to_state(rows: DataFrame, root: str, batch_id: int, snapshot_every: int) -> None:
    """Store what a batch adds; every `snapshot_every` batches merge all into a snapshot.

    Idempotent: a replayed batch replaces its own delta and snapshot, which are made from
    the state before it.
    """
    spark = rows.sparkSession
    delta = f"{root}/delta={batch_id}"
    rows.write.mode("overwrite").parquet(delta)
    if len(state_folders(spark, root, batch_id + 1)) > snapshot_every:
        whole = state_before(spark, root, rows.schema, batch_id).unionByName(spark.read.schema(rows.schema).parquet(delta))
        whole.distinct().write.mode("overwrite").parquet(f"{root}/snapshot={batch_id}")


def drop_merged(spark: SparkSession, root: str, batch_id: int) -> None:
    """Remove what a snapshot before this batch holds too.

    To be called when the batch starts: the checkpoint has then committed all batches
    before it, and none of them is run again.
    """
    last = max((n for n in _numbers(spark, root, "snapshot") if n < batch_id), default=None)
    if last is None:
        return
    for kind, upto in (("delta", last), ("snapshot", last - 1)):
        for n in _numbers(spark, root, kind):
            if n <= upto:
                remove_path(spark, f"{root}/{kind}={n}")


def state_rows(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The state after the last batch."""
    last = max([*_numbers(spark, root, "delta"), *_numbers(spark, root, "snapshot")], default=-1)
    return state_before(spark, root, schema, last + 1).select(*[F.col(f.name) for f in schema.fields])
