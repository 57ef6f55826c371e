"""Queries: key repair, mapping, triage, status, document plan, validation, record contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import fields as X
from ..operators import mapping as M
from ..operators import quality as Q
from ..operators import report as R
from ..operators import status as ST
from ..operators import validate as V
from . import bidstar as star
from .documents import process_documents
from .registry import query

DOUBLE = "double"
RUN = "run-1"


# ---- quality of a record ------------------------------------------------------------------------------
@query("""SELECT contract_number, round((9 + CASE WHEN combined_goal IS NOT NULL THEN 1 ELSE 0 END) / 10.0, 6) AS invitation,
  round((6 + CASE WHEN awarded_amount IS NOT NULL THEN 1 ELSE 0 END) / 7.0, 6) AS award,
  round(2 / 3.0, 6) AS bid_tabs FROM o""")
def completeness(spark, sf_dir):
    """An empty list counts as filled, an empty string does not."""
    values = lambda kind, **more: {**{f: F.col(f) for f in S.EXPECTED_FIELDS[kind] if f in S.SCALAR_TYPES}, **more}
    score = lambda v, kind: F.round(ST.completeness(v, F.lit(len(S.EXPECTED_FIELDS[kind]))), 6)
    lists = {"bidders": F.array(), "bid_items": F.lit(None).cast(S.LIST_TYPES["bid_items"])}
    return star.contracts(spark, sf_dir).select(
        "contract_number",
        score(values(S.INVITATION), S.INVITATION).alias("invitation"),
        score(values(S.AWARD), S.AWARD).alias("award"),
        score({"contract_number": F.col("contract_number"), **lists}, S.BID_TABS).alias("bid_tabs"),
    )


@query("""SELECT doc_id, CASE WHEN short AND filled = 0 THEN 'no_text_extracted,empty_data' WHEN short AND filled = 1 AND no_lists
    THEN 'no_text_extracted,low_field_coverage' WHEN short THEN 'no_text_extracted' WHEN filled = 0 THEN 'empty_data'
    WHEN filled = 1 AND no_lists THEN 'low_field_coverage' ELSE '' END AS reasons
  FROM (SELECT doc_id, length(text) < 50 AS short, doc_id % 2 = 0 AS no_lists,
    CASE WHEN lang = 'en' THEN 1 ELSE 0 END + CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS filled FROM documents)""")
def ocr_triage(spark, sf_dir):
    """Raw documents with a key where English, a blank or real county; even ones have two empty lists."""
    d = F.col("doc_id")
    empty = lambda name: F.when(d % 2 == 0, F.array().cast(S.LIST_TYPES[name]))
    values = {
        "contract_number": F.when(F.col("lang") == "en", d.cast("string")),
        "counties": F.when(d % 3 == 0, F.lit("Wake")).otherwise(F.lit(" \n")),
        "bidders": empty("bidders"),
        "bid_items": empty("bid_items"),
    }
    reasons = ST.triage_reasons(values, F.length("text"), F.when(F.trim("text") != "", 1).otherwise(0))
    return star.table(spark, sf_dir, "documents").select("doc_id", F.array_join(reasons, ",").alias("reasons"))


@query("""SELECT contract_number AS truth, CASE WHEN k % 4 = 0 THEN contract_number WHEN da THEN contract_number
    WHEN k % 4 = 3 THEN contract_number END AS contract_number,
  CASE WHEN k % 4 <> 0 AND (da OR k % 4 = 3) THEN 'filename' END AS contract_number_source FROM docs""")
def repair_key(spark, sf_dir):
    """Missing keys (null or empty) come from the file name; eight digits next to `_` are not a key."""
    k = F.col("k")
    cn = F.col("contract_number")
    names = F.when(k % 4 == 3, F.concat(cn, F.lit(" Bid Tabs.pdf"))).otherwise(F.concat(F.lower(cn), F.lit("_Bid Tabs.pdf")))
    key = F.when(k % 4 == 0, cn).when(k % 4 == 1, F.lit(""))
    docs = star.contracts(spark, sf_dir).select(cn.alias("truth"), key.alias("key"), names.alias("file_name"))
    repaired = ST.repaired_key(F.col("key"), F.col("file_name"))
    return docs.select(
        "truth", F.when(repaired != "", repaired).alias("contract_number"),
        ST.key_source(F.col("key"), F.col("file_name")).alias("contract_number_source"),
    )


@query("""SELECT c_custkey, nullif(upper(trim(CASE WHEN c_custkey % 4 = 0 THEN '   ' WHEN c_custkey % 4 = 1 THEN '  ' || lower(c_name)
  || ' ' ELSE c_name END)), '') AS key FROM customer""")
def normalize_key(spark, sf_dir):
    k, name = F.col("c_custkey"), F.col("c_name")
    raw = F.when(k % 4 == 0, "  \t ").when(k % 4 == 1, F.concat(F.lit("\n "), F.lower(name), F.lit(" "))).otherwise(name)
    return star.table(spark, sf_dir, "customer").select("c_custkey", X.normalize_key(raw).alias("key"))


@query("""SELECT event_id, CASE WHEN event_type = 'signup' THEN 'skipped' WHEN event_type = 'view' THEN 'skipped'
    WHEN event_type = 'error' THEN 'failed' WHEN value < 10 OR user_id % 7 = 0 THEN 'partial' ELSE 'success' END AS status FROM events""")
def status_machine(spark, sf_dir):
    """signup has an unknown type, view is unchanged, error failed; low values need OCR, some lack a key."""
    e = star.table(spark, sf_dir, "events")
    is_type = lambda t: F.col("event_type") == t
    reasons = ST.partial_reasons(F.when(F.col("user_id") % 7 != 0, F.lit("DA1")), F.lit(True))
    status = ST.final_status(
        F.when(is_type("signup"), S.UNKNOWN).otherwise(S.AWARD), ~is_type("error"), F.col("value") < 10, reasons, is_type("view")
    )
    return e.select("event_id", status.alias("status"))


# ---- mapping -----------------------------------------------------------------------------------------
@query("""SELECT contract_number, wbs_element, counties, description, CAST(date_available AS VARCHAR) AS date_available,
  CAST(completion_date AS VARCHAR) AS completion_date, mbe_goal, wbe_goal, combined_goal,
  strftime(bid_opening_date, '%Y-%m-%d %H:%M:%S') AS bid_opening_date FROM o""")
def apply_mapping(spark, sf_dir):
    """Whitelist: award and item C columns of the wide contract table are gone after the invitation mapping."""
    mapped = M.apply_mapping(star.contracts(spark, sf_dir), M.DEFAULT_MAPPINGS[S.INVITATION])
    as_text = [F.col(c).cast("string").alias(c) if c.endswith("date") or c == "date_available" else F.col(c) for c in mapped.columns]
    return mapped.select(*as_text)


ALIASED = {
    "mapping_name": "award_custom",
    "fields": ["contract_number", "county", "amount", "awarded_to"],
    "aliases": {"counties": "county", "awarded_amount": "amount", "location": "awarded_to", "missing": "contract_number"},
}


@query("SELECT contract_number, awarded_to, counties AS county, CAST(awarded_amount AS DOUBLE) AS amount FROM o")
def apply_mapping_alias(spark, sf_dir):
    """Aliases fill only targets that are not there under their own name, even where those are null."""
    mapped = M.apply_mapping(star.contracts(spark, sf_dir), ALIASED)
    return mapped.withColumn("amount", F.col("amount").cast(DOUBLE))


@query("""SELECT contract_number, bidder_name AS company, bidder_location,
  CAST(total_bid_amount AS DOUBLE) AS total_bid_amount FROM b""")
def map_list_items(spark, sf_dir):
    docs = star.bidder_docs(spark, sf_dir).select("contract_number", F.col("bids").alias("bidders"))
    mapping = {
        "fields": ["contract_number", "bidders"],
        "list_fields": {
            "bidders": {"fields": ["company", "bidder_location", "total_bid_amount"], "aliases": {"bidder_name": "company"}}
        },
    }
    rows = M.apply_mapping(docs, mapping).select("contract_number", F.inline("bidders"))
    return rows.withColumn("total_bid_amount", F.col("total_bid_amount").cast(DOUBLE))


@query("""SELECT file_path, document_type <> 'unknown' AS applied, CASE WHEN document_type <> 'unknown' THEN document_type || '_default' END
    AS mapping_name, CASE WHEN document_type <> 'unknown' THEN 'default' END AS mapping_source,
  CASE document_type WHEN 'invitation_to_bid' THEN 10 WHEN 'award_letter' THEN 7 WHEN 'bid_tabs' THEN 3 WHEN 'item_c_report' THEN 8
    WHEN 'unknown' THEN 0 ELSE 2 END AS expected_fields
  FROM (SELECT file_path, CASE doc_id % 7 WHEN 0 THEN 'invitation_to_bid' WHEN 1 THEN 'bid_tabs' WHEN 2 THEN 'award_letter'
    WHEN 3 THEN 'item_c_report' WHEN 4 THEN 'bid_summary' WHEN 5 THEN 'bids_as_read' ELSE 'unknown' END AS document_type FROM f)""")
def mapping_meta(spark, sf_dir):
    from ..operators.classify import classify_filename

    config = M.MappingConfig("/nowhere/source")
    files = star.files(spark, sf_dir).select("file_path", classify_filename(F.col("file_path")).alias("kind"))
    return files.select("file_path", M.mapping_meta(F.col("kind"), config).alias("m")).select(
        "file_path", F.coalesce("m.applied", F.lit(False)).alias("applied"), "m.mapping_name", "m.mapping_source",
        F.greatest(F.coalesce(F.size("m.expected_fields"), F.lit(0)), F.lit(0)).alias("expected_fields"),
    )


# ---- document plan -------------------------------------------------------------------------------------
def results(spark, sf_dir) -> DataFrame:
    """The document plan over one document per contract."""
    return process_documents(star.documents(spark, sf_dir), RUN, M.MappingConfig("/nowhere/source"))


@query("""SELECT file_path, document_type, status, found_key AS contract_number, n_bidders, n_items,
  CASE WHEN t = 2 AND NOT empty THEN CAST(awarded_amount AS DOUBLE) END AS awarded_amount,
  CASE WHEN NOT empty AND t = 0 THEN CAST(date_available AS VARCHAR) WHEN NOT empty AND t = 3 THEN CAST(date_available AS VARCHAR) END
    AS date_available, CASE WHEN t = 0 AND NOT empty THEN wbe_goal END AS wbe_goal FROM rs""")
def extract_all(spark, sf_dir):
    size = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)).cast("bigint")
    return results(spark, sf_dir).select(
        "file_path", "document_type", "status", "data.contract_number",
        size("data.bidders").alias("n_bidders"), size("data.bid_items").alias("n_items"),
        F.col("data.awarded_amount").cast(DOUBLE).alias("awarded_amount"),
        F.col("data.date_available").cast("string").alias("date_available"), "data.wbe_goal",
    )


@query("""SELECT file_path, document_type, status, contract_number, ocr_applied, reasons FROM (
  SELECT file_path, document_type, ocr_applied,
    CASE WHEN document_type = 'unknown' THEN NULL WHEN ocr_applied AND NOT da AND t IN (0, 2) THEN NULL
         WHEN ocr_applied THEN contract_number ELSE found_key END AS contract_number,
    CASE WHEN document_type = 'unknown' THEN 'skipped'
         WHEN ocr_applied THEN CASE WHEN NOT da AND t IN (0, 2) THEN 'partial' WHEN t = 1 THEN 'partial' ELSE 'success' END
         ELSE status END AS status,
    CASE WHEN document_type <> 'unknown' THEN CASE WHEN ocr_applied AND NOT da AND t = 0 THEN 'empty_data'
         WHEN ocr_applied AND NOT da AND t = 2 THEN 'empty_data'
         WHEN ocr_applied AND t = 1 THEN 'low_field_coverage' ELSE '' END END AS reasons
  FROM (SELECT *, document_type <> 'unknown' AND (empty OR (t IN (1, 4, 5, 6) AND bids IS NULL)) AS ocr_applied FROM rs))""")
def ocr_substitute(spark, sf_dir):
    """Flagged documents are read again from their OCR text; the others never look at it."""
    docs = star.documents(spark, sf_dir)
    scanned = star.contracts(spark, sf_dir).select(
        "k", F.concat(F.lit("Scanned sheet of the contract office, page one of one\nContract "), F.col("contract_number"),
                      F.lit("\n")).alias("ocr_text"), F.lit("scan").alias("ocr_method"))
    done = process_documents(docs.join(scanned, "k", "left"), RUN, M.MappingConfig("/nowhere/source"))
    return done.select(
        "file_path", "document_type", "status", "data.contract_number", F.coalesce("meta.ocr_applied", F.lit(False)).alias("ocr_applied"),
        F.array_join("meta.needs_ocr_reasons", ",").alias("reasons"),
    )


# ---- business rules --------------------------------------------------------------------------------------
def _bidders(spark, sf_dir):
    return star.bidders(spark, sf_dir).drop("k", "tenths")


MONEY_TEXT = "regexp_replace(CAST({x} AS VARCHAR), '(\\.[0-9])0$', '\\1')"


@query(f"""SELECT contract_number,
    awarded_amount IS NULL OR awarded_amount = 0 OR (win.w IS NOT NULL AND NOT (win.w.amt <> 0
      AND abs(CAST(awarded_amount AS DOUBLE) - CAST(win.w.amt AS DOUBLE)) > 0.01)) AS valid,
    CASE WHEN awarded_amount IS NULL OR awarded_amount = 0 THEN 'No award data to validate'
      WHEN win.w IS NULL THEN 'Winner marked in contract but no winner found in bidders'
      WHEN win.w.amt <> 0 AND abs(CAST(awarded_amount AS DOUBLE) - CAST(win.w.amt AS DOUBLE)) > 0.01 THEN
        'Award amount mismatch: ' || {MONEY_TEXT.format(x='awarded_amount')} || ' != ' || {MONEY_TEXT.format(x='win.w.amt')}
      ELSE 'Contract totals validated' END AS message
  FROM aw LEFT JOIN (SELECT k, min_by({{'amt': total_bid_amount}}, house) AS w FROM b WHERE is_winner OR bid_rank = 1 GROUP BY k) win USING (k)""")
def v_contract_totals(spark, sf_dir):
    return V.contract_totals(star.awarded(spark, sf_dir), _bidders(spark, sf_dir))


MISMATCH_SQL = """SELECT contract_number, house, bidder_name, total_bid_amount, coalesce(s, 0) AS items_sum FROM b
  LEFT JOIN (SELECT contract_number, bidder_name, sum(CASE WHEN total_price <> 0 THEN total_price END) AS s FROM li GROUP BY 1, 2) x
    USING (contract_number, bidder_name)
  WHERE total_bid_amount <> 0 AND abs(CAST(total_bid_amount AS DOUBLE) - CAST(coalesce(s, 0) AS DOUBLE)) > 1.0"""


@query(f"""SELECT o.contract_number, coalesce(n, 0) = 0 AS valid, coalesce(n, 0) AS mismatches,
  CASE WHEN nb.bids IS NULL THEN 'No data to validate' WHEN n IS NULL THEN 'Bid items validated' ELSE 'Bid items sum mismatch' END AS message
  FROM o LEFT JOIN nb USING (k) LEFT JOIN (SELECT contract_number, count(*) AS n FROM ({MISMATCH_SQL}) GROUP BY 1) m USING (contract_number)""")
def v_bid_items_sum(spark, sf_dir):
    return V.bid_items_sum(star.contracts(spark, sf_dir), _bidders(spark, sf_dir), star.line_items(spark, sf_dir))


@query(f"""SELECT contract_number, house AS position, bidder_name, CAST(total_bid_amount AS DOUBLE) AS total_bid_amount,
  CAST(items_sum AS DOUBLE) AS items_sum FROM ({MISMATCH_SQL})""")
def v_bid_items_sum_details(spark, sf_dir):
    rows = V.item_mismatches(_bidders(spark, sf_dir), star.line_items(spark, sf_dir))
    return rows.select("contract_number", "position", "bidder_name", F.col("total_bid_amount").cast(DOUBLE).alias("total_bid_amount"),
                       F.col("items_sum").cast(DOUBLE).alias("items_sum"))


FENCES_SQL = """SELECT contract_number, count(*) AS n, quantile_cont(CAST(total_bid_amount AS DOUBLE), 0.25) AS q1,
  quantile_cont(CAST(total_bid_amount AS DOUBLE), 0.75) AS q3 FROM b GROUP BY 1"""
OUTLIERS_SQL = f"""SELECT o.contract_number, round(q1, 4) AS q1, round(q3, 4) AS q3, coalesce(outs, 0) AS outliers,
  coalesce(outs, 0) = 0 AS valid, CASE WHEN coalesce(n, 0) < 4 THEN 'Insufficient data for outlier detection'
    WHEN q3 - q1 = 0 THEN 'No dispersion for outlier detection' WHEN coalesce(outs, 0) = 0 THEN 'No bidder total outliers'
    ELSE 'Outlier bid totals detected' END AS message
  FROM o LEFT JOIN ({FENCES_SQL}) q USING (contract_number) LEFT JOIN (
    SELECT contract_number, count(*) AS outs FROM b JOIN ({FENCES_SQL}) USING (contract_number)
    WHERE n >= 4 AND q3 - q1 <> 0 AND (total_bid_amount < q1 - 1.5 * (q3 - q1) OR total_bid_amount > q3 + 1.5 * (q3 - q1))
    GROUP BY 1) x USING (contract_number)"""


def _outliers(spark, sf_dir):
    verdicts = V.bidder_outliers(star.contracts(spark, sf_dir), _bidders(spark, sf_dir))
    return verdicts.withColumn("q1", F.round("q1", 4)).withColumn("q3", F.round("q3", 4))


@query(OUTLIERS_SQL)
def v_bidder_outliers(spark, sf_dir):
    return _outliers(spark, sf_dir)


@query(OUTLIERS_SQL)
def v_bidder_outliers_large(spark, sf_dir):
    """The same query under its earlier name: contracts of all sizes take one path."""
    return _outliers(spark, sf_dir)


DATES_CASE = """CASE WHEN date_available >= completion_date THEN 'Date available must be before completion date'
  WHEN bid_opening_date > CAST(award_date AS TIMESTAMP) THEN 'Bid opening must be before award date'
  WHEN bid_opening_date >= CAST(date_available AS TIMESTAMP) THEN 'Bid opening should be before availability date'
  ELSE 'Dates validated' END"""
GOALS_BAD = "combined_goal IS NOT NULL AND abs(combined_goal - (mbe_goal + wbe_goal)) > 0.1 AND combined_goal < mbe_goal + wbe_goal"
GOALS_CASE = f"""CASE WHEN combined_goal IS NULL THEN 'Goals not all specified' WHEN {GOALS_BAD} THEN 'Combined goal (' ||
  CAST(combined_goal AS VARCHAR) || ') inconsistent with MBE (' || CAST(mbe_goal AS VARCHAR) || ') + WBE (' || CAST(wbe_goal AS VARCHAR) || ')'
  ELSE 'Goals validated' END"""


@query(f"SELECT contract_number, message = 'Dates validated' AS valid, message FROM (SELECT contract_number, {DATES_CASE} AS message FROM o)")
def v_dates(spark, sf_dir):
    return V.contract_dates(star.contracts(spark, sf_dir))


@query(f"SELECT contract_number, NOT coalesce({GOALS_BAD}, false) AS valid, {GOALS_CASE} AS message FROM o")
def v_goals(spark, sf_dir):
    return V.contract_goals(star.contracts(spark, sf_dir))


# Rules of the document plan's results, written out from the source tables.
AMOUNTS_SQL = """
  SELECT k, house + 2 AS pos, bidder_name, CASE WHEN t = 1 THEN next_total ELSE total_bid_amount END AS amt
    FROM b JOIN rs USING (k) WHERE status = 'success' AND (t IN (1, 3, 4, 5, 6))
  UNION ALL SELECT k, 0, 'DATE AVAILABLE', CAST(day(date_available) AS DECIMAL(15,2)) FROM rs WHERE status = 'success' AND t = 3
  UNION ALL SELECT k, 1, 'FINAL COMPLETION', CAST(day(completion_date) AS DECIMAL(15,2)) FROM rs WHERE status = 'success' AND t = 3"""
RULES_SQL = f"""
am AS ({AMOUNTS_SQL}),
fe AS (SELECT k, count(amt) AS n, quantile_cont(CAST(amt AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(amt AS DOUBLE), 0.75) AS q3 FROM am GROUP BY k),
ou AS (SELECT k, string_agg(bidder_name || ': ' || {MONEY_TEXT.format(x='amt')}, ', ' ORDER BY pos) AS names FROM am JOIN fe USING (k)
  WHERE n >= 4 AND q3 <> q1 AND (amt < q1 - 1.5 * (q3 - q1) OR amt > q3 + 1.5 * (q3 - q1)) GROUP BY k),
wr AS (SELECT k, string_agg(bidder_name || ': total=$' || {MONEY_TEXT.format(x='amt')} || ', items_sum=$0', '; ' ORDER BY pos) AS names
  FROM am JOIN rs USING (k) WHERE t = 1 AND amt IS NOT NULL GROUP BY k),
ru AS (
  SELECT file_path, 'contract_totals' AS rule, NOT (t = 2 AND awarded_amount IS NOT NULL) AS valid, CASE WHEN t = 2 AND awarded_amount IS NOT NULL
    THEN 'Winner marked in contract but no winner found in bidders' ELSE 'No award data to validate' END AS message FROM rs WHERE status = 'success'
  UNION ALL
  SELECT file_path, 'bid_items_sum', wr.names IS NULL, CASE WHEN t <> 1 THEN 'No data to validate' WHEN wr.names IS NULL THEN 'Bid items validated'
    ELSE 'Bid items sum mismatch: ' || wr.names END FROM rs LEFT JOIN wr USING (k) WHERE status = 'success'
  UNION ALL
  SELECT file_path, 'dates', NOT bad_a AND NOT bad_b, CASE WHEN bad_a THEN 'Date available must be before completion date'
    WHEN bad_b THEN 'Bid opening should be before availability date' ELSE 'Dates validated' END
    FROM (SELECT file_path, t IN (0, 3) AND date_available >= completion_date AS bad_a,
      t = 0 AND bid_opening_date >= CAST(date_available AS TIMESTAMP) AS bad_b FROM rs WHERE status = 'success')
  UNION ALL
  SELECT file_path, 'goals', NOT (t = 0 AND coalesce({GOALS_BAD}, false)), CASE WHEN t = 0 THEN {GOALS_CASE} ELSE 'Goals not all specified' END
    FROM rs WHERE status = 'success'
  UNION ALL
  SELECT file_path, 'bidder_outliers', ou.names IS NULL, CASE WHEN coalesce(n, 0) < 4 THEN 'Insufficient data for outlier detection'
    WHEN q1 = q3 THEN 'No dispersion for outlier detection' WHEN ou.names IS NULL THEN 'No bidder total outliers'
    ELSE 'Outlier bid totals detected: ' || ou.names END FROM rs LEFT JOIN fe USING (k) LEFT JOIN ou USING (k) WHERE status = 'success')"""


def _with_rules(select: str) -> str:
    from .registry import STAR

    return STAR.rstrip() + "," + RULES_SQL + "\n" + select


@query(_with_rules("SELECT file_path, rule, valid, message FROM ru"))
def validate_all(spark, sf_dir):
    return V.rule_table(V.validate_results(results(spark, sf_dir)))


@query(_with_rules("SELECT file_path, rule, message FROM ru WHERE NOT valid"))
def failed_rules(spark, sf_dir):
    return V.failed_rules(V.validate_results(results(spark, sf_dir))).select("file_path", "rule", "message")


@query(_with_rules("""SELECT total, valid, total - valid AS invalid, format('{:.1f}%', valid * 100.0 / total) AS pass_rate
  FROM (SELECT count(*) AS total, count(*) FILTER (ok) AS valid FROM (SELECT file_path, bool_and(valid) AS ok FROM ru GROUP BY 1))"""))
def validation_summary(spark, sf_dir):
    return R.validation_summary(V.validate_results(results(spark, sf_dir)))


@query(_with_rules("""SELECT document_type, total, successful, partial, skipped, failed_validation, bidders, items FROM (
  SELECT document_type, count(*) AS total, count(*) FILTER (status = 'success') AS successful, count(*) FILTER (status = 'partial') AS partial,
    count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (NOT coalesce(ok, true)) AS failed_validation,
    CAST(sum(n_bidders) AS BIGINT) AS bidders, CAST(sum(n_items) AS BIGINT) AS items
  FROM rs LEFT JOIN (SELECT file_path, bool_and(valid) AS ok FROM ru GROUP BY 1) USING (file_path) GROUP BY 1)"""))
def bid_audit(spark, sf_dir):
    """Flagship: write out, classify, extract, map, decide the status, validate, sum up by document type."""
    size = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)).cast("bigint")
    judged = V.validate_results(results(spark, sf_dir))
    return judged.groupBy("document_type").agg(
        F.count(F.lit(1)).alias("total"),
        *(F.count_if(F.col("status") == s).alias(n) for s, n in
          (("success", "successful"), ("partial", "partial"), ("skipped", "skipped"))),
        F.count_if(~F.col("valid")).alias("failed_validation"),
        F.sum(size("data.bidders")).alias("bidders"),
        F.sum(size("data.bid_items")).alias("items"),
    )


# ---- record contracts and constraints ----------------------------------------------------------------------
def _errors(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, F.array_join("errors", ",").alias("errors"))


@query("""SELECT k, concat_ws(',', CASE WHEN k % 6 = 0 THEN 'contract_number_empty' END, CASE WHEN k % 5 = 0 THEN 'source_file_path_missing' END,
  CASE WHEN k % 4 = 0 THEN 'date_available_type' END, CASE WHEN k % 3 = 0 THEN 'mbe_goal_type' END) AS errors FROM o""")
def schema_contract(spark, sf_dir):
    """Contracts as loose text records: blank keys, missing paths, unreadable dates and goals."""
    k = F.col("k")
    raw = star.contracts(spark, sf_dir).select(
        "k",
        F.when(k % 6 == 0, F.lit("  ")).otherwise(F.col("contract_number")).alias("contract_number"),
        F.when(k % 5 != 0, F.lit("landing/a.pdf")).alias("source_file_path"),
        F.when(k % 4 == 0, F.lit("soon")).otherwise(F.col("date_available").cast("string")).alias("date_available"),
        F.when(k % 3 == 0, F.lit("n/a")).otherwise(F.col("mbe_goal").cast("string")).alias("mbe_goal"),
        F.col("awarded_amount").cast("string").alias("awarded_amount"),
    )
    return _errors(Q.check_contracts(raw), "k")


@query("""SELECT contract_number, house AS position, concat_ws(',', CASE WHEN house % 6 = 0 THEN 'bidder_name_empty' END,
  CASE WHEN house % 5 = 1 THEN 'bid_rank_type' END, CASE WHEN house % 4 = 1 THEN 'total_bid_amount_negative' END) AS errors FROM b""")
def schema_bidder(spark, sf_dir):
    h = F.col("position")
    raw = star.bidders(spark, sf_dir).select(
        "contract_number", "position",
        F.when(h % 6 == 0, F.lit("")).otherwise(F.col("bidder_name")).alias("bidder_name"),
        F.when(h % 5 == 1, F.lit("first")).otherwise(F.col("bid_rank").cast("string")).alias("bid_rank"),
        F.when(h % 4 == 1, -F.col("total_bid_amount")).otherwise(F.col("total_bid_amount")).cast("string").alias("total_bid_amount"),
    )
    return _errors(Q.check_bidders(raw), "contract_number", "position")


@query("""SELECT k, position, concat_ws(',', CASE WHEN k % 8 = 0 THEN 'contract_number_missing' END,
  CASE WHEN position % 3 = 0 THEN 'quantity_type' END) AS errors FROM it""")
def schema_item(spark, sf_dir):
    raw = star.items(spark, sf_dir).select(
        "k", "position",
        F.when(F.col("k") % 8 != 0, F.col("contract_number")).alias("contract_number"),
        F.when(F.col("position") % 3 == 0, F.lit("many")).otherwise(F.col("quantity").cast("string")).alias("quantity"),
        F.col("total_price").cast("string").alias("total_price"),
    )
    return _errors(Q.check_items(raw), "k", "position")


@query("""SELECT event_id, concat_ws(',', CASE WHEN event_type = 'view' THEN 'extraction_method_missing' END,
  CASE WHEN value > 100 THEN 'confidence_score_range' END) AS errors FROM events""")
def schema_result(spark, sf_dir):
    e = star.table(spark, sf_dir, "events")
    raw = star.log_of(e).select(
        F.regexp_extract("file_path", "[0-9]+", 0).cast("bigint").alias("event_id"), "file_path", "document_type", "status",
        F.when(F.col("status") != "skipped", F.lit("reader")).alias("extraction_method"),
    ).join(e.select("event_id", (F.col("value") / 100).alias("confidence_score")), "event_id")
    return _errors(Q.check_results(raw), "event_id")


@query("""SELECT * FROM (
  SELECT 'contracts' AS table_name, 'not_null:contract_number' AS constraint_name, 0 AS violations
  UNION ALL SELECT 'contracts', c, 0 FROM (SELECT unnest(['length:contract_number', 'length:wbs_element', 'length:type_of_work', 'length:awarded_to',
    'fits:wbe_goal', 'fits:combined_goal', 'fits:proposal_length', 'fits:estimated_cost', 'fits:awarded_amount']) AS c)
  UNION ALL SELECT 'contracts', 'fits:mbe_goal', 2 * count(*) FILTER (k >= 1000 AND o_orderstatus = 'P')
    + count(*) FILTER (k >= 1000 AND o_orderstatus <> 'P') FROM o
  UNION ALL SELECT 'contracts', 'unique:contract_number', count(*) FROM (SELECT contract_number FROM (SELECT contract_number FROM o UNION ALL
    SELECT contract_number FROM o WHERE o_orderstatus = 'P') GROUP BY 1 HAVING count(*) > 1)
  UNION ALL SELECT 'extraction_logs', 'not_null:file_path', 0
  UNION ALL SELECT 'extraction_logs', c, 0 FROM (SELECT unnest(['length:document_type', 'length:status']) AS c)
  UNION ALL SELECT 'extraction_logs', 'domain:status', count(*) FROM r WHERE status = 'skipped')""")
def constraint_report(spark, sf_dir):
    """Contracts with an overflowing goal and repeated keys; a run log with a status outside the domain."""
    c = star.contracts(spark, sf_dir).withColumn("mbe_goal", F.col("k").cast(DOUBLE)).drop("k")
    pending = star.table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(
        star.contract_key(F.col("o_orderkey")).alias("contract_number"))
    doubled = c.unionByName(c.join(pending, "contract_number", "left_semi"))
    log = star.run_log(spark, sf_dir).select("file_path", "document_type", "status")
    report = Q.constraint_report(doubled, "contracts").unionByName(Q.constraint_report(log, "extraction_logs"))
    return report


@query("""SELECT 'bidders' AS table_name, 'foreign_key:contract_number' AS constraint_name, count(*) AS violations FROM b WHERE k IN (SELECT k FROM o
    WHERE o_orderstatus <> 'F')
  UNION ALL SELECT 'bid_items', 'foreign_key:contract_number', count(*) FROM it WHERE k IN (SELECT k FROM o WHERE o_orderstatus <> 'F')
  UNION ALL SELECT 'contracts', 'unique:contract_number', count(*) FROM o WHERE o_orderstatus = 'F' AND k % 3 = 0
  UNION ALL SELECT 'bidders', 'fits:percentage_diff', count(*) FROM b WHERE tenths >= 100000
  UNION ALL SELECT 'bidders', 'not_null:bidder_name', count(*) FROM b WHERE house = 3
  UNION ALL SELECT 'bid_items', 'length:item_code', count(*) FROM it WHERE position = 2""")
def database_constraints(spark, sf_dir):
    """Contracts of finished orders, every third one twice; bidders and items of all orders, some with broken values."""
    done = star.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k"))
    old = star.contracts(spark, sf_dir).join(done, "k", "left_semi")
    tables = {
        "contracts": old.unionByName(old.where("k % 3 = 0")).select("contract_number", "wbs_element"),
        "bidders": star.bidders(spark, sf_dir).select(
            "contract_number", F.when(F.col("position") != 3, F.col("bidder_name")).alias("bidder_name"), "percentage_diff"),
        "bid_items": star.items(spark, sf_dir).select(
            "contract_number", F.when(F.col("position") == 2, F.repeat("item_code", 60)).otherwise(F.col("item_code")).alias("item_code")),
    }
    wanted = ["foreign_key:contract_number", "unique:contract_number", "fits:percentage_diff", "not_null:bidder_name", "length:item_code"]
    return Q.database_report(tables).where(F.col("constraint_name").isin(*wanted))
