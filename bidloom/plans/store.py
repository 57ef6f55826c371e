"""Loading a run's results into a snapshot store: all tables change in one commit, and only in the buckets that the run touches."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..operators import incremental
from ..operators import load as L
from ..session import materialise
from ..sources.snapshots import Change, Commit, SnapshotStore

#: Table and the column whose hash deals its rows into buckets.
KEYS = {
    "contracts": L.KEY, "bidders": L.KEY, "bid_items": L.KEY, "extraction_logs": "file_path", "contract_changes": L.KEY,
    "rejected_rows": "file_path", "loaded_files": "source_file_hash", "state": "file_path",
}
CHILD = {"contract_id": "bigint", L.KEY: "string", "source_file_path": "string", "source_file_hash": "string", "position": "int"}


def _schema(columns: dict[str, str]) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"{c} {t}" for c, t in columns.items()))


def _tables(change: Change) -> None:
    audit = {c: "timestamp" for c in L.AUDIT}
    run = {"run_id": "string", "run_ts": "timestamp"}
    for name, columns in {
        "contracts": S.CONTRACT_COLUMNS | audit, "bidders": CHILD | S.BIDDER_COLUMNS, "bid_items": CHILD | S.ITEM_COLUMNS,
        "extraction_logs": S.LOG_COLUMNS, "rejected_rows": {"file_path": "string", "table_name": "string", "columns": "array<string>"} | run,
        "loaded_files": {"source_file_hash": "string"},
    }.items():
        change.create(name, KEYS[name], _schema(columns))
    change.create("state", KEYS["state"], T.StructType.fromDDL(incremental.STATE_SCHEMA))
    change.create("contract_changes", KEYS["contract_changes"], T.StructType.fromDDL(L.CHANGES))


def upsert(change: Change, name: str, incoming: DataFrame, order: str, run_ts=None) -> DataFrame:
    """Upsert `incoming` into the table of contracts `name` and return what changed. Buckets without an incoming key are neither read
    nor written."""
    keyed = incoming.where(F.col(L.KEY).isNotNull())
    buckets = change.touched(name, keyed, L.KEY)
    existing = change.read(name, buckets)
    merged = materialise(L.upsert_contracts(existing, incoming, order, run_ts), f"merged-{name}")
    change.rewrite(name, merged, buckets)
    return L.contract_changes(existing, merged, incoming)


def load_batch(results: DataFrame, store: SnapshotStore, run_id: str, run_ts: datetime.datetime) -> Commit:
    """Load results on top of the latest commit: contracts, bidders, items, log, refused rows, the feed of changes and the state of files.

    A run that is in the store already is not loaded again. A run that breaks before its commit leaves the tables as they were, and can be
    repeated; one that another run has overtaken raises CommitConflict and is repeated by the caller. Children carry the `contract_id` of
    their contract. `results` are read several times, so they should be written first.
    """
    change = store.change(run_id)
    if run_id in change.base.runs:
        return change.base
    _tables(change)
    at = F.lit(run_ts).cast("timestamp")
    stamped = lambda df: df.withColumn("run_id", F.lit(run_id)).withColumn("run_ts", at)

    incoming = materialise(L.contract_rows(results), "contract-rows").withColumn("_order", F.col("source_file_path"))
    feed = materialise(stamped(upsert(change, "contracts", incoming, "_order", at)), "contract-changes")
    change.append("contract_changes", feed)

    parents = feed.select(L.KEY)
    bidders = materialise(L.child_rows(results, "bidders"), "bidder-rows")
    known = change.read("bidders", change.touched("bidders", bidders))
    fresh = L.new_bidders(
        known, L.accepted_batches(bidders).withColumn("_order", F.struct("source_file_path", "position")), "_order").drop("_order")
    change.append("bidders", L.children_with_id(fresh, parents))

    items = materialise(L.child_rows(results, "bid_items"), "item-rows")
    loaded = change.read("loaded_files", change.touched("loaded_files", items, "source_file_hash"))
    change.append("bid_items", L.children_with_id(L.new_items(loaded, items), parents))
    hashes = items.select("source_file_hash").distinct()
    change.append("loaded_files", hashes.join(loaded, "source_file_hash", "left_anti"))

    change.append("extraction_logs", L.log_rows(results))
    change.append("rejected_rows", stamped(L.rejected_rows(results)))
    done = results.select("file_path", "status", "meta.file_hash", "meta.file_size_bytes", "meta.file_mtime")
    paths = change.touched("state", done.where("status = 'success'"))
    seen = change.read("state", paths)
    change.rewrite("state", incremental.merge_state(seen, done), paths)
    return change.commit()


def stored_state(store: SnapshotStore) -> DataFrame:
    """State of files for `extract_batch`: that of the latest commit."""
    commit = store.latest()
    if "state" in commit.tables:
        return store.read("state", commit)
    return store.spark.createDataFrame([], incremental.STATE_SCHEMA)
