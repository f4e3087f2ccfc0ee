"""Daily increments over tables that their own job reads and rewrites.

Each job is a function of the stored version and a batch, stored as a new version. A run that is
lost half-way leaves no complete version and is simply repeated. The day's rows are the batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession

from txloom.operators import account_activity, coinjoin, fast_tx, inactivity, spending
from txloom.schemas import LAST_ACTIVITY
from txloom.sources.sinks import append_run, read_buckets, read_runs, reload, touched_buckets, update_snapshot, write_buckets


STATE_BUCKETS = 64
_ACTIVE = "address string, first_activate_timestamp timestamp, latest_activate_timestamp timestamp"
_INACTIVE = "address string, latest_activate_timestamp timestamp, create_time timestamp"
_PERIODIC = "address string, create_time timestamp"


def run_inactivity(
    spark: SparkSession,
    root: str,
    activity: DataFrame,
    now: datetime,
    horizon: inactivity.Horizon = inactivity.UTXO_HORIZON,
    buckets: int = STATE_BUCKETS,
    version: str | None = None,
) -> inactivity.InactivityTables:
    """One run of the inactivity tables under `root`: state, inactive, periodic.

    State and inactive addresses lie in buckets of the address. A run reads and rewrites the buckets of the addresses
    in its batch; the others stay as an earlier run wrote them. What is too old to matter is passed over by every read
    and leaves the disk when its bucket is next rewritten: a row that is too old stays so. Inactive addresses are
    rewritten only in buckets where one is added or returns. Periodic ones are appended. Each `version` of the tables
    (by default the time `now`) is made from the versions before it, so a repeated run gives the same tables.
    """
    version = version or now.strftime("%Y%m%dT%H%M%S")
    state_root, quiet_root, periodic_root = f"{root}/state", f"{root}/inactive", f"{root}/periodic"

    def current(only: Sequence[int] | None = None, before: str | None = version) -> DataFrame:
        return inactivity.expire_state(read_buckets(spark, state_root, LAST_ACTIVITY, before, only), now, horizon)

    batch = f"{root}/batch/{version}"
    reload(inactivity.activity_span(activity).select(*[c.split()[0] for c in _ACTIVE.split(", ")]), batch)
    span = spark.read.schema(_ACTIVE).parquet(batch)
    touched = touched_buckets(span, "address", buckets)
    before = current(touched)

    def returning(kept: DataFrame | None) -> DataFrame:
        return inactivity.returning_addresses(before, span, kept, now, horizon.gap)

    append_run(spark, periodic_root, version, returning)

    quiet = read_buckets(spark, quiet_root, _INACTIVE, version)
    added = inactivity.inactive_addresses(current(), quiet, now, horizon.inactive)
    # an address that returns in this batch is neither added nor kept
    back = quiet.join(span.select("address"), "address", "left_semi")
    added = added.join(span.select("address"), "address", "left_anti")
    changed = touched_buckets(added.select("address").unionByName(back.select("address")), "address", buckets)
    kept = read_buckets(spark, quiet_root, _INACTIVE, version, changed).join(span.select("address"), "address", "left_anti")
    write_buckets(kept.unionByName(added), quiet_root, version, "address", buckets, changed)

    write_buckets(inactivity.merge_state(before, span, horizon), state_root, version, "address", buckets, touched)
    after = stored_inactivity(spark, root)
    return inactivity.InactivityTables(current(before=None), after.inactive, after.periodic)


def stored_inactivity(spark: SparkSession, root: str) -> inactivity.InactivityTables:
    """The inactivity tables as the last run left them; rows of the state that are too old may still be there."""
    periodic = read_runs(spark, f"{root}/periodic")
    return inactivity.InactivityTables(
        read_buckets(spark, f"{root}/state", LAST_ACTIVITY),
        read_buckets(spark, f"{root}/inactive", _INACTIVE),
        spark.createDataFrame([], _PERIODIC) if periodic is None else periodic,
    )


def run_address_totals(
    spark: SparkSession, root: str, tx: DataFrame, run_date: date, null_fee_as_zero: bool = False
) -> DataFrame:
    """Transaction counts and fees per address, increased by the day before `run_date`."""
    return update_snapshot(
        spark,
        root,
        run_date.isoformat(),
        lambda kept: account_activity.address_tx_cnt_and_fee(tx, run_date, kept, null_fee_as_zero=null_fee_as_zero),
    )


def run_frequent_io(spark: SparkSession, root: str, tx: DataFrame, run_date: date) -> DataFrame:
    return update_snapshot(spark, root, run_date.isoformat(), lambda kept: spending.frequent_io(tx, run_date, kept))


def run_mimo(spark: SparkSession, root: str, tx: DataFrame, run_date: date) -> DataFrame:
    return update_snapshot(spark, root, run_date.isoformat(), lambda kept: coinjoin.mimo_addresses(tx, run_date, kept))


def run_fast_tx(spark: SparkSession, root: str, tx: DataFrame, run_date: date) -> DataFrame:
    return update_snapshot(spark, root, run_date.isoformat(), lambda kept: fast_tx.utxo_fast_tx(tx, run_date, kept))


def run_dates(first: date, last: date) -> list[date]:
    """Run dates that process the days `first` to `last`."""
    return [first + timedelta(days=n + 1) for n in range((last - first).days + 1)]


def midnight(day: date) -> datetime:
    return datetime.combine(day, time())
