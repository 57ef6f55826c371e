"""Queries: table rows, upsert, deduplication, incremental runs, listings, routing, result files."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import incremental as I
from ..operators import load as L
from ..operators import report as R
from ..sources import files as FS
from ..session import fresh_path
from ..sources import sinks as K
from ..sources.snapshots import SnapshotStore
from . import bidstar as star
from .catalog_rules import RUN, results
from .registry import query
from .store import upsert

DOUBLE = "double"


def _double(*names: str):
    return [F.col(n).cast(DOUBLE).alias(n) for n in names]


def _text(*names: str):
    return [F.col(n).cast("string").alias(n) for n in names]


# ---- tables from results -------------------------------------------------------------------------------
@query("""SELECT file_path AS source_file_path, found_key AS contract_number,
  CASE WHEN t IN (0, 2) AND NOT empty THEN wbs_element END AS wbs_element,
  CASE WHEN t IN (0, 3) AND NOT empty THEN CAST(date_available AS VARCHAR) END AS date_available,
  CASE WHEN t = 0 AND NOT empty THEN strftime(bid_opening_date, '%Y-%m-%d %H:%M:%S') END AS bid_opening_date,
  CASE WHEN t = 0 AND NOT empty THEN mbe_goal END AS mbe_goal,
  CASE WHEN t = 3 AND NOT empty THEN proposal_length END AS proposal_length,
  CASE WHEN t = 3 AND NOT empty THEN CAST(estimated_cost AS DOUBLE) END AS estimated_cost,
  CASE WHEN t = 2 AND NOT empty THEN CAST(awarded_amount AS DOUBLE) END AS awarded_amount,
  CASE WHEN t = 2 AND NOT empty THEN CAST(award_date AS VARCHAR) END AS award_date,
  '2024-01-01 00:00:00' AS source_file_mtime, 'run-1' AS extraction_run_id
  FROM rs WHERE status IN ('success', 'partial')""")
def contracts_table(spark, sf_dir):
    rows = L.contract_rows(results(spark, sf_dir))
    return rows.select(
        "source_file_path", "contract_number", "wbs_element", "extraction_run_id",
        *_text("date_available", "bid_opening_date", "award_date", "source_file_mtime"),
        *_double("mbe_goal", "proposal_length", "estimated_cost", "awarded_amount"),
    )


@query("""SELECT contract_number, position, bidder_name, CAST(amt AS DOUBLE) AS total_bid_amount, bid_rank, false AS is_winner FROM (
  SELECT rs.found_key AS contract_number, CASE WHEN t = 3 THEN ordinal + 1 ELSE ordinal - 1 END AS position, bidder_name,
    CASE WHEN t = 1 THEN next_total ELSE total_bid_amount END AS amt,
    CASE WHEN t = 3 THEN ordinal + 2 WHEN t = 1 THEN ordinal ELSE bid_rank END AS bid_rank
    FROM rs JOIN b USING (k) WHERE t IN (1, 3, 4, 5, 6) AND NOT empty AND document_type <> 'unknown'
      AND NOT (t IN (3, 4) AND k IN (SELECT k FROM b WHERE tenths >= 100000))
  UNION ALL SELECT found_key, 0, 'DATE AVAILABLE', day(date_available), 1 FROM rs
    WHERE t = 3 AND NOT empty AND k NOT IN (SELECT k FROM b WHERE tenths >= 100000)
  UNION ALL SELECT found_key, 1, 'FINAL COMPLETION', day(completion_date), 2 FROM rs
    WHERE t = 3 AND NOT empty AND k NOT IN (SELECT k FROM b WHERE tenths >= 100000))
  WHERE contract_number IS NOT NULL""")
def bidders_table(spark, sf_dir):
    """A document with a percentage that the table's decimal(6,2) cannot hold loads none of its bidders."""
    rows = L.child_rows(results(spark, sf_dir), "bidders")
    return rows.select("contract_number", "position", "bidder_name", *_double("total_bid_amount"), "bid_rank", "is_winner")


@query("""SELECT found_key AS contract_number, item_number, item_code, it.description AS description, CAST(quantity AS DOUBLE) AS quantity, unit,
  CAST(unit_price AS DOUBLE) AS unit_price, CAST(total_price AS DOUBLE) AS total_price
  FROM rs JOIN it USING (k) WHERE t = 1 AND NOT empty AND found_key IS NOT NULL""")
def items_table(spark, sf_dir):
    rows = L.child_rows(results(spark, sf_dir), "bid_items")
    return rows.select(
        "contract_number", "item_number", "item_code", "description", "unit", *_double("quantity", "unit_price", "total_price"))


@query("""SELECT file_path, document_type, status, CASE document_type WHEN 'invitation_to_bid' THEN 'InvitationToBidExtractor'
    WHEN 'bid_tabs' THEN 'BidTabsExtractor' WHEN 'award_letter' THEN 'AwardLetterExtractor' WHEN 'item_c_report' THEN 'ItemCExtractor'
    WHEN 'bid_summary' THEN 'BidSummaryExtractor' WHEN 'bids_as_read' THEN 'BidsAsReadExtractor' END AS extraction_method,
  CASE WHEN document_type = 'unknown' THEN 'No extractor available for this document type' END AS error_message,
  CAST(n_bidders + n_items AS INTEGER) AS records_extracted,
  document_type <> 'unknown' AND (empty OR (t IN (1, 4, 5, 6) AND bids IS NULL)) AS needs_ocr,
  CASE WHEN document_type <> 'unknown' AND (empty OR (t IN (1, 4, 5, 6) AND bids IS NULL)) THEN
    CASE WHEN found_key IS NULL THEN 'no_text_extracted,empty_data' WHEN t = 1 THEN 'no_text_extracted,low_field_coverage'
      ELSE 'no_text_extracted' END END AS needs_ocr_reasons,
  CASE WHEN document_type <> 'unknown' THEN 'run-1' END AS run_id FROM rs""")
def extraction_log(spark, sf_dir):
    return L.log_rows(results(spark, sf_dir)).select(
        "file_path", "document_type", "status", "extraction_method", "error_message",
        F.coalesce("records_extracted", F.lit(0)).alias("records_extracted"),
        F.coalesce("needs_ocr", F.lit(False)).alias("needs_ocr"), "needs_ocr_reasons", "run_id")


@query("""SELECT total, successful, total - successful AS failed, format('{:.1f}%', successful / total * 100) AS success_rate FROM (
  SELECT count(*) AS total, count(*) FILTER (status NOT IN ('success', 'partial') OR found_key IS NOT NULL) AS successful FROM rs)""")
def load_summary(spark, sf_dir):
    return L.load_summary(results(spark, sf_dir))


# ---- upsert and deduplication -----------------------------------------------------------------------------
def _open_contracts(spark, sf_dir):
    """Contracts loaded by an earlier run: the finished orders."""
    done = star.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k"))
    return star.contracts(spark, sf_dir).join(done, "k", "left_semi")


@query("""SELECT coalesce(n.contract_number, e.contract_number) AS contract_number, coalesce(n.type_of_work, e.type_of_work) AS type_of_work,
  coalesce(n.location, e.location) AS location, CAST(coalesce(n.cost, e.estimated_cost) AS DOUBLE) AS estimated_cost, e.wbs_element
  FROM (SELECT * FROM o WHERE o_orderstatus = 'F') e FULL JOIN (
    SELECT contract_number, arg_max(item_code, position) FILTER (position % 2 = 0) AS type_of_work,
      arg_max(description, position) FILTER (position % 3 = 0) AS location, arg_max(total_price, position) AS cost
    FROM it GROUP BY 1) n ON n.contract_number = e.contract_number""")
def upsert_contracts(spark, sf_dir):
    """Several documents per contract, each with some fields: the last non-null value of each field wins."""
    merged = L.upsert_contracts(_old_contracts(spark, sf_dir), _item_documents(spark, sf_dir), "position")
    return merged.withColumn("estimated_cost", F.col("estimated_cost").cast(DOUBLE))


def _old_contracts(spark, sf_dir):
    return _open_contracts(spark, sf_dir).select("contract_number", "type_of_work", "location", "estimated_cost", "wbs_element")


def _item_documents(spark, sf_dir):
    pos = F.col("position")
    return star.items(spark, sf_dir).select(
        "contract_number", "position",
        F.when(pos % 2 == 0, F.col("item_code")).alias("type_of_work"),
        F.when(pos % 3 == 0, F.col("description")).alias("location"),
        F.col("total_price").alias("estimated_cost"),
    )


def _stored_upsert(spark, sf_dir):
    """Old contracts in one commit of a store, then the documents of contracts that end in 7 in another; its feed and the store."""
    store = SnapshotStore(spark, fresh_path(spark, "store"))
    first = store.change("run-0")
    old = _old_contracts(spark, sf_dir)
    first.create("contracts", L.KEY, old.schema)
    first.append("contracts", old)
    first.commit()
    second = store.change(RUN)
    incoming = _item_documents(spark, sf_dir).where("contract_number LIKE '%7'").withColumn(
        "estimated_cost", F.col("estimated_cost").cast("decimal(15,2)"))
    feed = upsert(second, "contracts", incoming, "position")
    second.commit()
    return feed, store


_SEVENS = """(SELECT contract_number, arg_max(item_code, position) FILTER (position % 2 = 0) AS type_of_work,
      arg_max(description, position) FILTER (position % 3 = 0) AS location, arg_max(total_price, position) AS cost
    FROM it WHERE contract_number LIKE '%7' GROUP BY 1)"""


@query(f"""SELECT coalesce(n.contract_number, e.contract_number) AS contract_number, coalesce(n.type_of_work, e.type_of_work) AS type_of_work,
  coalesce(n.location, e.location) AS location, CAST(coalesce(n.cost, e.estimated_cost) AS DOUBLE) AS estimated_cost, e.wbs_element
  FROM (SELECT * FROM o WHERE o_orderstatus = 'F') e FULL JOIN {_SEVENS} n ON n.contract_number = e.contract_number""")
def snapshot_upsert(spark, sf_dir):
    """A batch into a store of bucketed snapshots; the whole table as of its last commit."""
    _, store = _stored_upsert(spark, sf_dir)
    return store.read("contracts").withColumn("estimated_cost", F.col("estimated_cost").cast(DOUBLE))


@query(f"""SELECT n.contract_number, CASE WHEN e.k IS NULL THEN 'inserted' WHEN n.type_of_work IS DISTINCT FROM e.type_of_work
      AND n.type_of_work IS NOT NULL OR n.location IS DISTINCT FROM e.location AND n.location IS NOT NULL
      OR n.cost IS DISTINCT FROM e.estimated_cost AND n.cost IS NOT NULL THEN 'updated' ELSE 'unchanged' END AS change,
    concat_ws(',', CASE WHEN n.cost IS NOT NULL AND n.cost IS DISTINCT FROM e.estimated_cost THEN 'estimated_cost' END,
      CASE WHEN n.location IS NOT NULL AND n.location IS DISTINCT FROM e.location THEN 'location' END,
      CASE WHEN n.type_of_work IS NOT NULL AND n.type_of_work IS DISTINCT FROM e.type_of_work THEN 'type_of_work' END) AS columns,
    e.k IS NOT NULL AND (n.cost IS NULL OR n.cost IS NOT DISTINCT FROM e.estimated_cost) AND (n.location IS NULL OR n.location IS NOT DISTINCT
      FROM e.location) AND (n.type_of_work IS NULL OR n.type_of_work IS NOT DISTINCT FROM e.type_of_work) AS same_hash
  FROM {_SEVENS} n LEFT JOIN (SELECT * FROM o WHERE o_orderstatus = 'F') e ON n.contract_number = e.contract_number""")
def change_feed(spark, sf_dir):
    """What that batch did to each of its contracts."""
    feed, _ = _stored_upsert(spark, sf_dir)
    same = F.coalesce(F.col("before_hash") == F.col("after_hash"), F.lit(False))
    return feed.select("contract_number", "change", F.array_join("columns", ",").alias("columns"), same.alias("same_hash"))


@query("""SELECT contract_number, bidder_name, CAST(total_bid_amount AS DOUBLE) AS total_bid_amount FROM (
  SELECT contract_number, bidder_name, total_bid_amount, k FROM b WHERE k NOT IN (SELECT k FROM o WHERE o_orderstatus = 'F')
  UNION ALL SELECT contract_number, bidder_name, total_bid_amount + 1, k FROM b)""")
def dedup_bidders(spark, sf_dir):
    """Each bid comes twice, once in another spelling, and once more with another amount."""
    b = star.bidders(spark, sf_dir)
    columns = ["contract_number", "bidder_name", "total_bid_amount", "seq"]
    seq = F.col("position")
    variants = [
        b.withColumn("seq", seq),
        b.withColumn("seq", seq + 100).withColumn("bidder_name", F.concat(F.lit(" "), F.lower("bidder_name"))),
        b.withColumn("seq", seq + 200).withColumn("total_bid_amount", (F.col("total_bid_amount") + 1).cast("decimal(15,2)")),
    ]
    incoming = variants[0].select(*columns).unionByName(variants[1].select(*columns)).unionByName(variants[2].select(*columns))
    done = star.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k"))
    existing = b.join(done, "k", "left_semi")
    return L.new_bidders(existing, incoming, "seq").select("contract_number", "bidder_name", *_double("total_bid_amount"))


@query("""SELECT contract_number, bidder_name, CAST(total_bid_amount AS DOUBLE) AS total_bid_amount FROM b
  WHERE k NOT IN (SELECT k FROM b WHERE house = 25)""")
def bidder_batch_reject(spark, sf_dir):
    """House 25 comes without a name and takes its contract's whole batch with it."""
    nameless = F.when(F.col("position") != 25, F.col("bidder_name"))
    kept = L.accepted_batches(star.bidders(spark, sf_dir).withColumn("bidder_name", nameless))
    return kept.select("contract_number", "bidder_name", *_double("total_bid_amount"))


@query("""SELECT contract_number, bidder_name FROM b WHERE k NOT IN (SELECT k FROM o WHERE o_orderstatus = 'F')""")
def fk_orphans(spark, sf_dir):
    return L.orphans(star.bidders(spark, sf_dir), _open_contracts(spark, sf_dir)).select("contract_number", "bidder_name")


# ---- incremental runs -----------------------------------------------------------------------------------------
SAME = "f.file_path = st.file_path AND f.file_hash = st.file_hash AND f.file_size_bytes = st.file_size_bytes AND f.file_mtime = st.file_mtime"


@query(f"SELECT f.file_path, f.file_hash FROM f ANTI JOIN st ON {SAME}")
def incremental_changed(spark, sf_dir):
    return I.changed(star.files(spark, sf_dir).drop("doc_id"), star.state(spark, sf_dir)).select("file_path", "file_hash")


@query(f"""SELECT f.file_path, CASE f.doc_id % 7 WHEN 0 THEN 'invitation_to_bid' WHEN 1 THEN 'bid_tabs' WHEN 2 THEN 'award_letter'
    WHEN 3 THEN 'item_c_report' WHEN 4 THEN 'bid_summary' WHEN 5 THEN 'bids_as_read' ELSE 'unknown' END AS document_type,
  'skipped' AS status, 'unchanged' AS error, f.file_hash, 'run-1' AS run_id FROM f SEMI JOIN st ON {SAME}""")
def incremental_skipped(spark, sf_dir):
    rows = I.skip_rows(star.files(spark, sf_dir), star.state(spark, sf_dir), RUN)
    return rows.select("file_path", "document_type", "status", "error", "file_hash", "run_id")


@query("""SELECT coalesce(st.file_path, n.file_path) AS file_path, coalesce(n.file_hash, st.file_hash) AS file_hash,
  coalesce(n.file_size_bytes, st.file_size_bytes) AS file_size_bytes,
  strftime(coalesce(n.file_mtime, st.file_mtime), '%Y-%m-%d %H:%M:%S') AS file_mtime
  FROM st FULL JOIN (SELECT * FROM f WHERE doc_id % 3 <> 0) n ON st.file_path = n.file_path""")
def state_merge(spark, sf_dir):
    """Every third file failed: its old state stays, or it stays unknown."""
    files = star.files(spark, sf_dir)
    done = files.withColumn("status", F.when(F.col("doc_id") % 3 == 0, "failed").otherwise("success"))
    return I.merge_state(star.state(spark, sf_dir), done).withColumn("file_mtime", F.col("file_mtime").cast("string"))


# ---- listings, fingerprints, routing -----------------------------------------------------------------------------
LISTING_SQL = "SELECT CASE WHEN doc_id % 4 = 0 THEN upper(file_path) WHEN doc_id % 4 = 1 THEN file_path || '.txt' ELSE file_path END AS key FROM f"


def _listing(spark, sf_dir):
    d, path = F.col("doc_id"), F.col("file_path")
    key = F.when(d % 4 == 0, F.upper(path)).when(d % 4 == 1, F.concat(path, F.lit(".txt"))).otherwise(path)
    return star.files(spark, sf_dir).select("doc_id", key.alias("key"))


@query(f"SELECT key FROM ({LISTING_SQL}) WHERE starts_with(key, 'src') AND lower(key) LIKE '%.pdf'")
def list_keys(spark, sf_dir):
    return FS.list_keys(_listing(spark, sf_dir), "src")


@query(f"SELECT key FROM ({LISTING_SQL}) WHERE starts_with(key, 'SRC') AND lower(key) LIKE '%.pdf' ORDER BY key LIMIT 25")
def list_keys_capped(spark, sf_dir):
    """The cap is the caller's wish, in listing order."""
    return FS.list_keys(_listing(spark, sf_dir), "SRC", max_items=25)


@query("""SELECT 'docs/' || doc_id AS file_path, sha256(text) AS file_hash, CAST(strlen(text) AS BIGINT) AS file_size_bytes,
  '2024-01-01T00:00:00+00:00' AS file_mtime_iso FROM documents""")
def fingerprint(spark, sf_dir):
    docs = star.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("docs/"), F.col("doc_id").cast("string")).alias("path"),
        F.to_timestamp_ltz(F.lit("2024-01-01 00:00:00+00:00")).alias("modificationTime"),
        F.octet_length("text").cast("bigint").alias("length"), F.col("text").cast("binary").alias("content"),
    )
    return FS.fingerprint(docs).select("file_path", "file_hash", "file_size_bytes", "file_mtime_iso")


@query("""SELECT 'raw/' || e.user_id % 3 || '/' || r.event_id || '.pdf' AS src_key,
  CASE WHEN status IN ('success', 'partial') THEN 'processed/' ELSE 'error/' END || r.event_id || '.pdf' AS new_key
  FROM r JOIN events e USING (event_id) WHERE e.event_type <> 'signup'""")
def route_sources(spark, sf_dir):
    """Local results to source keys; of two keys with one base name the last listed counts; sign-ups have none."""
    e = star.table(spark, sf_dir, "events")
    id_text = F.col("event_id").cast("string")
    key = lambda folder: F.concat(F.lit("raw/"), folder, F.lit("/"), id_text, F.lit(".pdf"))
    known = e.where("event_type <> 'signup'")
    first = known.select(key(F.lit("0")).alias("key"), F.lit(0).alias("seq"))
    last = known.select(key((F.col("user_id") % 3).cast("string")).alias("key"), F.lit(1).alias("seq"))
    keys = FS.key_map(first.unionByName(last), "run/", "seq")
    return K.route_sources(star.log_of(e), keys, "processed/", "error")


# ---- result files ---------------------------------------------------------------------------------------------------
@query("""SELECT file_path, found_key AS "data.contract_number", CASE WHEN t = 2 AND NOT empty THEN awarded_to END AS "data.awarded_to",
  CASE WHEN document_type <> 'unknown' THEN 'run-1' END AS "meta.run_id",
  CASE WHEN document_type <> 'unknown' THEN document_type || '_default' END AS "meta.mapping.mapping_name" FROM rs""")
def flatten_results(spark, sf_dir):
    flat = K.flatten(results(spark, sf_dir))
    names = ["file_path", "data.contract_number", "data.awarded_to", "meta.run_id", "meta.mapping.mapping_name"]
    return flat.select(*(F.col(f"`{n}`") for n in names))


@query("""SELECT 'summary' AS section, to_json({'total_files': count(*), 'failed': count(*) FILTER (status = 'failed')}) AS value FROM r
  UNION ALL SELECT 'results', to_json({'file_path': file_path, 'document_type': document_type, 'status': status, 'error': error}) FROM r""")
def report_json(spark, sf_dir):
    log = star.run_log(spark, sf_dir)
    summary = R.run_summary(log).select("total_files", "failed")
    return K.report_rows(summary, log.select("file_path", "document_type", "status", "error"))


@query("SELECT file_path, found_key AS contract_number, CAST(n_items AS INTEGER) AS bid_items_count FROM rs WHERE t = 1")
def items_report(spark, sf_dir):
    return R.items_report(results(spark, sf_dir))


@query("SELECT file_path, document_type, status FROM rs ORDER BY file_path LIMIT 3")
def sample_results(spark, sf_dir):
    """The console's sample of three, which is the feature."""
    return R.sample_results(results(spark, sf_dir)).select("file_path", "document_type", "status")
