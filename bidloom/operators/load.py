"""Set-based loading: contract upsert, child tables, deduplication, log rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.parse import falsy, percent_text
from ..functions.text import strip
from .fields import key_from_name, normalize_key
from .status import completeness, data_values, expected_count

KEY = "contract_number"


def loadable(results: DataFrame) -> DataFrame:
    return results.where(F.col("status").isin("success", "partial") & F.col("data").isNotNull())


def load_key(key: Column, file_name: Column) -> Column:
    """Trimmed upper-case key; a missing one is looked for in the file name."""
    return F.when(falsy(key, "text"), key_from_name(file_name)).otherwise(normalize_key(key))


def misfits(table: str, kinds: dict[str, str], value: Callable[[str], Column | None]) -> Column:
    """Names of the columns whose value the table's type or declared length cannot hold."""
    lengths = S.MAX_LENGTH[table]
    found = []
    for name, kind in kinds.items():
        v = value(name)
        if v is None:
            continue
        bad = v.try_cast(kind).isNull()
        if name in lengths:
            bad = bad | (F.length(v.cast("string")) > lengths[name])
        found.append(F.when(v.isNotNull() & bad, F.lit(name)))
    return F.array_compact(F.array(*found))


def contract_misfits() -> Column:
    """Columns over a result that the contracts table would refuse."""
    given = {**{f: F.col(f"data.{f}") for f in S.SCALAR_TYPES}, "source_file_hash": F.col("meta.file_hash"),
             "extraction_run_id": F.col("meta.run_id"), KEY: load_key(F.col("data.contract_number"), F.col("file_name"))}
    return misfits("contracts", S.CONTRACT_COLUMNS, given.get)


def list_misfits(list_name: str) -> Column:
    """Columns that any entry of a result's bidders or bid items breaks; one broken entry refuses the whole list."""
    kinds = S.BIDDER_COLUMNS if list_name == "bidders" else S.ITEM_COLUMNS
    rows = F.transform(f"data.{list_name}", lambda row: misfits(list_name, kinds, lambda c: row[c]))
    return F.array_distinct(F.flatten(rows))


def rejected_rows(results: DataFrame) -> DataFrame:
    """What the tables refuse: (file_path, table_name, columns), a row per result and table. A refused contract takes the
    lists of its document with it."""
    named = [("contracts", contract_misfits()), *((n, F.coalesce(list_misfits(n), F.array())) for n in ("bidders", "bid_items"))]
    entries = F.array(*(F.struct(F.lit(n).alias("table_name"), c.cast("array<string>").alias("columns")) for n, c in named))
    return loadable(results).select("file_path", F.inline(entries)).where(F.size("columns") > 0)


def contract_rows(results: DataFrame) -> DataFrame:
    """One contract row per loadable result, typed as the contracts table; rows without key stay null-keyed.

    A result with a value that the table cannot hold gives no row (`rejected_rows` names it)."""
    meta = {
        "contract_number": load_key(F.col("data.contract_number"), F.col("file_name")),
        "source_file_path": F.col("file_path"),
        "source_file_hash": F.col("meta.file_hash"),
        "source_file_mtime": F.col("meta.file_mtime"),
        "extraction_run_id": F.col("meta.run_id"),
    }
    columns = []
    for name, kind in S.CONTRACT_COLUMNS.items():
        if name in meta:
            value = meta[name]
        elif name in S.SCALAR_TYPES:
            value = F.col(f"data.{name}")
        else:
            value = F.lit(None)
        columns.append(value.try_cast(kind).alias(name))
    return loadable(results).where(F.size(contract_misfits()) == 0).select(*columns)


def child_rows(results: DataFrame, list_name: str) -> DataFrame:
    """Explode bidders or bid_items of loadable results with a key into (contract_number, position, ...).

    Lists with an entry that does not fit, and all lists of a refused contract, are left out (`rejected_rows`)."""
    columns = S.BIDDER_COLUMNS if list_name == "bidders" else S.ITEM_COLUMNS
    fits = (F.size(contract_misfits()) == 0) & (F.size(F.coalesce(list_misfits(list_name), F.array())) == 0)
    exploded = loadable(results).where(fits).select(
        load_key(F.col("data.contract_number"), F.col("file_name")).alias(KEY),
        F.col("file_path").alias("source_file_path"),
        F.col("meta.file_hash").alias("source_file_hash"),
        F.posexplode(f"data.{list_name}").alias("position", "row"),
    )
    typed = [F.col(f"row.{c}").try_cast(t).alias(c) for c, t in columns.items()]
    rows = exploded.where(F.col(KEY).isNotNull()).select(
        KEY, "source_file_path", "source_file_hash", "position", *typed
    )
    return rows.withColumn("is_winner", F.coalesce("is_winner", F.lit(False))) if list_name == "bidders" else rows


def latest_values(incoming: DataFrame, order: str) -> DataFrame:
    """Per key and column the last non-null value in processing order; aggregates before the shuffle."""
    values = [c for c in incoming.columns if c not in (KEY, order)]
    return (
        incoming.where(~falsy(F.col(KEY), "text"))
        .groupBy(KEY)
        .agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in values))
    )


def upsert_contracts(existing: DataFrame, incoming: DataFrame, order: str, run_ts: Column | None = None) -> DataFrame:
    """New snapshot of the contracts table.

    A known key takes every non-null incoming value, a null never erases; a new key is inserted; rows
    without key are rejected. Columns that only one side has are kept. With `run_ts` the audit columns
    `created_at` and `updated_at` are written, without it those of the old snapshot stay as they are.
    """
    new = latest_values(incoming, order)
    values = [c for c in new.columns if c != KEY]
    audit = () if run_ts is None else ("created_at", "updated_at")
    old_audit = {c: F.col(f"old.{c}") if c in existing.columns else F.lit(None).cast("timestamp") for c in audit}
    old, fresh = existing.alias("old"), new.withColumn("_in", F.lit(True)).alias("new")
    merged = old.join(fresh, KEY, "full_outer")
    columns = [
        F.coalesce(F.col(f"new.{c}"), F.col(f"old.{c}")).alias(c) if c in existing.columns else F.col(f"new.{c}")
        for c in values if c not in audit
    ]
    columns += [F.col(f"old.{c}") for c in existing.columns if c not in (KEY, *audit, *values)]
    if run_ts is not None:
        touched = F.col("new._in").isNotNull()
        columns += [
            F.coalesce(old_audit["created_at"], run_ts).alias("created_at"),
            F.when(touched, run_ts).otherwise(old_audit["updated_at"]).alias("updated_at"),
        ]
    return merged.select(KEY, *columns)


AUDIT = ("created_at", "updated_at")
CHANGES = "contract_number string, change string, columns array<string>, before_hash bigint, after_hash bigint"


def contract_changes(existing: DataFrame, merged: DataFrame, incoming: DataFrame) -> DataFrame:
    """What an upsert did to each incoming key: (key, change, columns, before_hash, after_hash, after).

    `change` is inserted, updated or unchanged, `columns` names the columns that differ (all filled ones of a new row), `after` is the
    new row. Values are compared null-safe, audit columns left out; the hashes are of the same columns. Rows of `merged` that come from
    `existing` alone have no entry, so the feed is as long as the batch."""
    values = sorted(c for c in merged.columns if c not in (KEY, *AUDIT))
    before = [F.col(f"b.{c}") if c in existing.columns else F.lit(None).cast(merged.schema[c].dataType) for c in values]
    keys = incoming.where(~falsy(F.col(KEY), "text")).select(KEY).distinct()
    whole = F.struct(*(F.col(f"a.{c}") for c in merged.columns)).alias("after")
    sides = merged.alias("a").join(keys.alias("k"), KEY, "left_semi").alias("a").join(
        existing.withColumn("_old", F.lit(True)).alias("b"), F.col(f"a.{KEY}") == F.col(f"b.{KEY}"), "left")
    differ = F.array_compact(F.array(*(F.when(~F.col(f"a.{c}").eqNullSafe(old), F.lit(c)) for c, old in zip(values, before))))
    known = F.col("b._old").isNotNull()
    return sides.select(
        F.col(f"a.{KEY}").alias(KEY), known.alias("_known"), differ.alias("columns"),
        F.when(known, F.xxhash64(*_null_safe(before))).alias("before_hash"),
        F.xxhash64(*_null_safe([F.col(f"a.{c}") for c in values])).alias("after_hash"), whole,
    ).select(
        KEY, F.when(~F.col("_known"), "inserted").when(F.size("columns") > 0, "updated").otherwise("unchanged").alias("change"),
        "columns", "before_hash", "after_hash", "after")


def _null_safe(columns: list[Column]) -> list[Column]:
    """A hash skips nulls, so that (null, x) and (x, null) would be equal: each column comes with whether it is null."""
    return [x for c in columns for x in (c.isNull(), c)]


def replay(existing: DataFrame, feed: DataFrame) -> DataFrame:
    """The table after the changes of a feed."""
    changed = feed.where("change in ('inserted', 'updated', 'unchanged')")
    new = changed.select("after.*")
    return existing.join(changed.select(KEY), KEY, "left_anti").unionByName(new, allowMissingColumns=True)


def contract_id(key: Column) -> Column:
    """Deterministic surrogate id."""
    return F.xxhash64(key)


def bidder_key(name: Column, amount: Column) -> Column:
    """Name and amount in canonical form; an amount is compared as decimal(15,2), not as text."""
    return F.concat(
        F.upper(strip(F.coalesce(name, F.lit("")))),
        F.lit("|"),
        F.coalesce(amount.cast("decimal(15,2)").cast("string"), F.lit("")),
    )


def new_bidders(existing: DataFrame, incoming: DataFrame, order: str) -> DataFrame:
    """Bidders to append: first seen of every (contract, name, amount) that the table does not hold yet.

    Repeats are folded by an aggregate, not a window, so a key that holds a large share of all rows is
    reduced before it is shuffled.
    """
    keyed = incoming.withColumn("_key", bidder_key(F.col("bidder_name"), F.col("total_bid_amount")))
    rest = [c for c in incoming.columns if c != KEY]
    first = keyed.groupBy(KEY, "_key").agg(F.min_by(F.struct(*rest), F.col(order)).alias("_row"))
    known = existing.select(KEY, bidder_key(F.col("bidder_name"), F.col("total_bid_amount")).alias("_key"))
    return first.join(known, [KEY, "_key"], "left_anti").select(KEY, "_row.*")


def accepted_batches(bidders: DataFrame) -> DataFrame:
    """All or nothing: a bidder without name rejects the whole contract's batch."""
    broken = bidders.groupBy(KEY).agg(F.bool_or(F.col("bidder_name").isNull()).alias("_bad")).where("_bad")
    return bidders.join(broken.select(KEY), KEY, "left_anti")


def new_items(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Items are appended without deduplication; a file that has been loaded before is left out whole."""
    loaded = existing.select("source_file_hash").groupBy("source_file_hash").count().drop("count")
    return incoming.join(loaded, "source_file_hash", "left_anti")


def log_rows(results: DataFrame) -> DataFrame:
    """One log row per result, whatever its status."""
    data, meta = F.col("data"), F.col("meta")
    records = F.greatest(F.size(data["bidders"]), F.lit(0)) + F.greatest(F.size(data["bid_items"]), F.lit(0))
    values = {
        "file_path": F.col("file_path"),
        "document_type": F.col("document_type"),
        "extraction_method": F.col("extraction_method"),
        "status": F.col("status"),
        "error_message": F.col("error"),
        "confidence_score": F.when(data.isNotNull(), completeness(data_values(data), expected_count(F.col("document_type")))),
        "processing_time_seconds": meta["processing_time"],
        "records_extracted": F.when(data.isNotNull(), F.coalesce(records, F.lit(0))),
        "needs_ocr": meta["needs_ocr"],
        "needs_ocr_reasons": F.when(F.size(meta["needs_ocr_reasons"]) > 0, F.array_join(meta["needs_ocr_reasons"], ",")),
        "ocr_applied": meta["ocr_applied"],
        "ocr_method": meta["ocr_method"],
        "ocr_duration_seconds": meta["ocr_duration_seconds"],
        "file_hash": meta["file_hash"],
        "file_size_bytes": meta["file_size_bytes"],
        "file_mtime": meta["file_mtime"],
        "run_id": meta["run_id"],
    }
    return results.select(*(values[c].try_cast(t).alias(c) for c, t in S.LOG_COLUMNS.items()))


def load_tables(
    results: DataFrame, existing: dict[str, DataFrame], order: str = "source_file_path", run_ts: Column | None = None
) -> dict[str, DataFrame]:
    """The four tables after loading `results` on top of `existing` (log, contracts, bidders, bid_items)."""
    bidders = child_rows(results, "bidders").withColumn("_order", F.struct("source_file_path", "position"))
    fresh = new_bidders(existing["bidders"], accepted_batches(bidders), "_order").drop("_order")
    items = new_items(existing["bid_items"], child_rows(results, "bid_items"))
    contracts = upsert_contracts(
        existing["contracts"], contract_rows(results).withColumn("_order", F.col(order)), "_order", run_ts
    )
    return {
        "extraction_logs": existing["extraction_logs"].unionByName(log_rows(results)),
        "contracts": contracts,
        "bidders": existing["bidders"].unionByName(fresh, allowMissingColumns=True),
        "bid_items": existing["bid_items"].unionByName(items, allowMissingColumns=True),
    }


def load_summary(results: DataFrame) -> DataFrame:
    """total, successful, failed, success_rate. Results that are only logged count as successful, refused ones as failed."""
    gate = F.col("status").isin("success", "partial") & F.col("data").isNotNull()
    key = load_key(F.col("data.contract_number"), F.col("file_name"))
    ok = F.coalesce(~gate | (~falsy(key, "text") & (F.size(contract_misfits()) == 0)), F.lit(False))
    counts = results.agg(F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("successful"))
    return counts.select(
        "total", "successful", (F.col("total") - F.col("successful")).alias("failed"),
        percent_text(F.col("successful"), F.col("total")).alias("success_rate"),
    )


def orphans(children: DataFrame, contracts: DataFrame) -> DataFrame:
    """Child rows whose contract does not exist."""
    return children.join(contracts.select(KEY), KEY, "left_anti")


def children_with_id(children: DataFrame, contracts: DataFrame) -> DataFrame:
    """Resolve the parent: only children of existing contracts, with the contract's surrogate id."""
    parents = contracts.select(KEY, contract_id(F.col(KEY)).alias("contract_id"))
    return children.join(parents, KEY)
