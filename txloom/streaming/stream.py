"""Increments as a stream: each micro-batch is a run of a (stored, batch) job.

A batch's number names the version or run it stores, and a run starts from what was stored before that number, so a
batch that is delivered again after a failure leaves the same tables. The stream's checkpoint lies beside the tables it
numbers, as the two only make sense together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txloom.operators import account_activity, coinjoin, inactivity
from txloom.functions.relations import new_rows
from txloom.sources.sinks import append_run, update_snapshot
from txloom.streaming.incremental import STATE_BUCKETS, run_inactivity

Job = Callable[[DataFrame | None, DataFrame], DataFrame]


def version_of(batch_id: int) -> str:
    """Batch numbers as names that sort as the numbers do."""
    return f"{batch_id:012d}"


def _started(stream: DataFrame, root: str, each: Callable[[DataFrame, int], None], **trigger) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", f"{root}/_checkpoint")
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def snapshot_stream(stream: DataFrame, root: str, job: Job, **trigger) -> StreamingQuery:
    """Every batch makes the next version of the table below `root`: job(stored version, batch)."""

    def each(batch: DataFrame, batch_id: int) -> None:
        update_snapshot(batch.sparkSession, root, version_of(batch_id), lambda kept: job(kept, batch))

    return _started(stream, root, each, **trigger)


def append_stream(stream: DataFrame, root: str, job: Job, **trigger) -> StreamingQuery:
    """Every batch appends what job(stored rows, batch) finds new."""

    def each(batch: DataFrame, batch_id: int) -> None:
        append_run(batch.sparkSession, root, version_of(batch_id), lambda kept: job(kept, batch))

    return _started(stream, root, each, **trigger)


def stream_address_totals(tx: DataFrame, root: str, null_fee_as_zero: bool = False, **trigger) -> StreamingQuery:
    """Transaction counts and fees per address, increased batch by batch."""
    totals = lambda kept, batch: account_activity.address_tx_cnt_and_fee(batch, None, kept, null_fee_as_zero)
    return snapshot_stream(tx, root, totals, **trigger)


def stream_mimo(tx: DataFrame, root: str, **trigger) -> StreamingQuery:
    """Addresses of transactions with many inputs and outputs, each appended once."""
    return append_stream(tx, root, lambda kept, batch: new_rows(coinjoin.mimo_addresses(batch), kept), **trigger)


def stream_inactivity(
    activity: DataFrame, root: str, horizon: inactivity.Horizon = inactivity.UTXO_HORIZON, buckets: int = STATE_BUCKETS, **trigger
) -> StreamingQuery:
    """The inactivity tables, one run a batch; the time of a run is the latest time in its batch, so a replay has the same."""

    def each(batch: DataFrame, batch_id: int) -> None:
        now = batch.agg(F.max(F.col("block_timestamp"))).first()[0]
        if now is not None:
            run_inactivity(batch.sparkSession, root, batch, now, horizon, buckets, version_of(batch_id))

    return _started(activity, root, each, **trigger)
