"""Queries: classification, field and group extraction, page texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import classify as C
from ..operators import fields as X
from ..operators import groups as G
from ..operators.asof import next_value
from ..session import materialise
from ..sources import pages as P
from . import bidstar as star
from .registry import query

DOUBLE = "double"


def _bidder_columns(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(
        F.col("doc_id").alias("contract_number"), "bidder_name", "bidder_location",
        F.col("total_bid_amount").cast(DOUBLE).alias("total_bid_amount"), "bid_rank", *extra,
    )


def _line_pages(spark: SparkSession, sf_dir: str, line, header: str) -> DataFrame:
    """One page per bidder: header line, bid line."""
    b = star.bidders(spark, sf_dir)
    row = {c: F.col(c) for c in b.columns}
    return b.select(
        F.col("contract_number").alias("doc_id"), F.col("position").alias("page_no"),
        F.concat(F.lit(header + "\n"), line(row), F.lit("\n")).alias("text"),
    )


# ---- bidders --------------------------------------------------------------------------------------
@query("""SELECT contract_number, bidder_name, bidder_location, CAST(total_bid_amount AS DOUBLE) AS total_bid_amount,
  bid_rank FROM b""")
def bidders_as_read(spark, sf_dir):
    pages = _line_pages(spark, sf_dir, star.as_read_line, "BIDS AS READ")
    return _bidder_columns(pages.select("doc_id", F.inline(G.line_bidders(S.AS_READ, F.col("text")))))


@query("""SELECT contract_number, bidder_name, bidder_location, CAST(total_bid_amount AS DOUBLE) AS total_bid_amount,
  bid_rank, nullif(tenths / 10.0, 0.0) AS percentage_diff FROM b""")
def bidders_summary(spark, sf_dir):
    pages = _line_pages(spark, sf_dir, star.summary_line, "BID SUMMARY")
    rows = pages.select("doc_id", F.inline(G.line_bidders(S.SUMMARY, F.col("text"))))
    return _bidder_columns(rows, "percentage_diff")


def _doc_bidders(spark, sf_dir, kind: str) -> DataFrame:
    docs = star.bidder_docs(spark, sf_dir)
    return docs.select(F.col("contract_number").alias("doc_id"), F.inline(G.bidders(kind, F.col(kind))))


@query("""SELECT contract_number, bidder_name, bidder_location, CAST(total_bid_amount AS DOUBLE) AS total_bid_amount,
  ordinal + 2 AS bid_rank, tenths / 10.0 AS percentage_diff FROM b
UNION ALL SELECT contract_number, 'DATE AVAILABLE', upper(strftime(date_available, '%b')),
  CAST(day(date_available) AS DOUBLE), 1, CAST(year(date_available) AS DOUBLE) FROM o WHERE k IN (SELECT k FROM b)
UNION ALL SELECT contract_number, 'FINAL COMPLETION', upper(strftime(completion_date, '%b')),
  CAST(day(completion_date) AS DOUBLE), 2, CAST(year(completion_date) AS DOUBLE) FROM o WHERE k IN (SELECT k FROM b)""")
def bidders_item_c(spark, sf_dir):
    """The date lines have the shape of a bid and are read as the first two bidders."""
    return _bidder_columns(_doc_bidders(spark, sf_dir, S.ITEM_C), "percentage_diff")


@query("""SELECT contract_number, bidder_name, bidder_location, CAST(next_total AS DOUBLE) AS total_bid_amount,
  ordinal AS bid_rank FROM b""")
def bidders_bid_tabs(spark, sf_dir):
    return _bidder_columns(_doc_bidders(spark, sf_dir, S.BID_TABS))


@query("""SELECT contract_number, house AS position, bidder_name, CAST(next_total AS DOUBLE) AS next_total FROM b""")
def asof_next_total(spark, sf_dir):
    b = materialise(star.bidders(spark, sf_dir).select("contract_number", "position", "bidder_name", "total_bid_amount"), "bids")
    left = b.select("contract_number", (F.col("position") * 2).alias("at"), "position", "bidder_name")
    right = b.select(
        "contract_number", (F.col("position") * 2 + 1).alias("at"),
        F.when(F.col("position") % 5 != 0, F.col("total_bid_amount")).alias("amount"),
    )
    matched = next_value(left, right, ["contract_number"], "at", "amount", "next_total")
    return matched.select("contract_number", "position", "bidder_name", F.col("next_total").cast(DOUBLE).alias("next_total"))


@query("SELECT contract_number, bidder_name, ordinal AS bid_rank FROM b")
def rank_fill(spark, sf_dir):
    line = lambda b: F.concat_ws(" ", b["bidder_name"], b["bidder_location"], star.money(b["total_bid_amount"]))
    rows = G.rank_fill(materialise(G.bidder_rows(_line_pages(spark, sf_dir, line, "BIDS AS READ"), S.AS_READ), "bidder-lines"))
    return rows.select(F.col("doc_id").alias("contract_number"), "bidder_name", "bid_rank")


@query("SELECT contract_number, bidder_name, bid_rank FROM b")
def rank_override(spark, sf_dir):
    docs = star.bidder_docs(spark, sf_dir)
    section = F.concat(
        F.col(S.BID_TABS), F.lit("\n\nBIDDERS IN ORDER\nCONTRACT TOTAL\n"),
        F.array_join(F.transform("bids", star.section_line), "\n"), F.lit("\n\n0001"),
    )
    return docs.select("contract_number", section.alias("text")).select(
        "contract_number", F.inline(G.bid_tab_bidders(F.col("text")))
    ).select("contract_number", "bidder_name", "bid_rank")


# ---- bid items ------------------------------------------------------------------------------------
ITEMS_SQL = """SELECT contract_number, item_number, {code} AS item_code, description, CAST(quantity AS DOUBLE) AS quantity,
  {unit} AS unit, CAST(unit_price AS DOUBLE) AS unit_price, CAST(total_price AS DOUBLE) AS total_price FROM it"""


def _item_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "contract_number", "item_number", "item_code", "description", F.col("quantity").cast(DOUBLE).alias("quantity"),
        "unit", F.col("unit_price").cast(DOUBLE).alias("unit_price"), F.col("total_price").cast(DOUBLE).alias("total_price"),
    )


def _item_row(df: DataFrame) -> dict:
    return {c: F.col(c) for c in df.columns}


def _cells(i: dict):
    """A two-row grid: the header and one item."""
    header = F.array(*(F.lit(h) for h in ("Item", "Description", "Quantity", "Unit", "Price", "Total")))
    row = F.array(
        i["item_number"], i["description"], star.money(i["quantity"]), i["unit"], star.money(i["unit_price"]),
        star.money(i["total_price"]),
    )
    return F.array(F.array(header, row))


@query(ITEMS_SQL.format(code="item_code", unit="unit"))
def items_from_text(spark, sf_dir):
    it = star.items(spark, sf_dir)
    pages = it.select(
        F.col("contract_number").alias("doc_id"), F.col("position").alias("page_no"),
        F.concat(F.lit("Roadway Items\n"), star.item_line(_item_row(it)), F.lit("\n")).alias("text"),
    )
    return _item_columns(G.item_rows(pages).withColumnRenamed("doc_id", "contract_number"))


@query(ITEMS_SQL.format(code="CAST(NULL AS VARCHAR)", unit="raw_unit"))
def items_from_table(spark, sf_dir):
    it = star.items(spark, sf_dir)
    return _item_columns(it.select("contract_number", _cells(_item_row(it)).alias("tables")).select(
        "contract_number", F.inline(G.table_items(F.col("tables")))))


@query(ITEMS_SQL.format(code="CASE WHEN k % 2 = 1 THEN item_code END", unit="CASE WHEN k % 2 = 1 THEN unit ELSE raw_unit END"))
def items_fallback(spark, sf_dir):
    """Even contracts have a cell grid, odd ones only text lines."""
    it = star.items(spark, sf_dir)
    row = _item_row(it)
    docs = it.select("contract_number", star.item_line(row).alias("text"), F.when(F.col("k") % 2 == 0, _cells(row)).alias("tables"))
    return _item_columns(docs.select("contract_number", F.inline(G.bid_tab_items(F.col("text"), F.col("tables")))))


@query("SELECT contract_number, k % 4 IN (0, 1) AS is_item_table FROM o")
def detect_item_table(spark, sf_dir):
    headers = [["ITEM NO.", "Description", "Qty", "Unit"], ["Line", "Total price", "Quantity"], ["Bidder", "Total"], ["Item", "Unit", "Price"]]
    k = F.col("k")
    row = F.array(F.col("contract_number"))
    grid = F
    for n, names in enumerate(headers):
        header = F.array(*(F.lit(h) for h in names))
        # the last form is a header without rows
        grid = grid.when(k % 4 == n, F.array(header, row) if n < 3 else F.array(header))
    return star.contracts(spark, sf_dir).select("contract_number", G.is_item_table(grid).alias("is_item_table"))


# ---- classification --------------------------------------------------------------------------------
BY_NAME = """CASE WHEN {n} LIKE '%invitation%' AND {n} LIKE '%bid%' THEN 'invitation_to_bid'
  WHEN {n} LIKE '%bid tab%' OR {n} LIKE '%bid\\_tab%' ESCAPE '\\' OR {n} LIKE '%bidtab%' THEN 'bid_tabs'
  WHEN {n} LIKE '%award%' AND {n} LIKE '%letter%' THEN 'award_letter'
  WHEN {n} LIKE '%item c%' OR {n} LIKE '%item\\_c%' ESCAPE '\\' OR {n} LIKE '%itemc%' THEN 'item_c_report'
  WHEN {n} LIKE '%bid summary%' OR {n} LIKE '%bidsummary%' THEN 'bid_summary'
  WHEN {n} LIKE '%bids as read%' OR {n} LIKE '%bids\\_as\\_read%' ESCAPE '\\' THEN 'bids_as_read' ELSE 'unknown' END"""
BY_TEXT = """CASE WHEN contains({t}, 'notice to prospective bidders') OR contains({t}, 'invitation to bid') THEN 'invitation_to_bid'
  WHEN contains({t}, 'notification of award') OR contains({t}, 'pleased to inform you that') THEN 'award_letter'
  WHEN contains({t}, 'item c') AND (contains({t}, '$ totals') OR contains({t}, '% diff')) THEN 'item_c_report'
  WHEN contains({t}, 'roadway items') AND (contains({t}, 'bidder') OR contains({t}, 'contractor')) THEN 'bid_tabs'
  WHEN contains({t}, 'bids as read') THEN 'bids_as_read' ELSE 'unknown' END"""
OPENINGS = [
    "Notice to Prospective Bidders", "Notification of Award", "Item C $ Totals % Diff", "Roadway Items Bidder", "BIDS AS READ",
    "Item C", "Roadway Items",
]
OPENINGS_SQL = "[" + ", ".join(f"'{o}'" for o in OPENINGS) + "][CAST(doc_id % 7 AS INTEGER) + 1]"


def _opened_documents(spark, sf_dir) -> DataFrame:
    """Raw documents, each behind one of the openings."""
    docs = star.table(spark, sf_dir, "documents")
    opening = F.get(F.array(*(F.lit(o) for o in OPENINGS)), (F.col("doc_id") % 7).cast("int"))
    return docs.select("doc_id", "source", F.concat(opening, F.lit("\n"), F.col("text")).alias("first_page"))


@query(f"SELECT file_path, {BY_NAME.format(n='lower(file_path)')} AS document_type FROM f")
def classify_filename(spark, sf_dir):
    files = star.files(spark, sf_dir)
    return files.select("file_path", C.classify_filename(F.col("file_path")).alias("document_type"))


@query(f"SELECT doc_id, {BY_TEXT.format(t='page')} AS document_type FROM "
       f"(SELECT doc_id, lower({OPENINGS_SQL} || chr(10) || text) AS page FROM documents)")
def classify_content(spark, sf_dir):
    docs = _opened_documents(spark, sf_dir)
    return docs.select("doc_id", C.classify_content(F.col("first_page")).alias("document_type"))


@query(f"SELECT file_path, CASE WHEN n <> 'unknown' THEN n ELSE t END AS document_type FROM (SELECT file_path, "
       f"{BY_NAME.format(n='lower(file_path)')} AS n, {BY_TEXT.format(t='page')} AS t FROM f JOIN "
       f"(SELECT doc_id, lower({OPENINGS_SQL} || chr(10) || text) AS page FROM documents) USING (doc_id))")
def classify(spark, sf_dir):
    label = F.get(F.array(*(F.lit(v) for v in star.LABELS)), (F.col("doc_id") % 7).cast("int"))
    d = F.col("doc_id").cast("string")
    docs = _opened_documents(spark, sf_dir)
    return C.classify(docs.withColumn("file_path", F.concat("source", F.lit("/"), d, F.lit("_"), label, F.lit(".pdf")))).select(
        "file_path", "document_type"
    )


TEXT_RULES = [
    ("contact", [["@"], ["http", "www", "tel"]]),
    ("licence", [["license", "licence", "copyright"]]),
    ("mail", [["@"]]),
    ("table", [["|"], ["---", "\t"]]),
]


@query("""SELECT doc_id, CASE WHEN contains(t, '@') AND (contains(t, 'http') OR contains(t, 'www') OR contains(t, 'tel')) THEN 'contact'
  WHEN contains(t, 'license') OR contains(t, 'licence') OR contains(t, 'copyright') THEN 'licence'
  WHEN contains(t, '@') THEN 'mail' WHEN contains(t, '|') AND (contains(t, '---') OR contains(t, chr(9))) THEN 'table'
  ELSE 'unknown' END AS label FROM (SELECT doc_id, lower(text) AS t FROM documents)""")
def rule_classify_text(spark, sf_dir):
    return star.table(spark, sf_dir, "documents").select("doc_id", C.rule_classify(F.col("text"), TEXT_RULES).alias("label"))


@query("""WITH rules AS (SELECT s_suppkey, CAST(s_suppkey % 97 AS VARCHAR) AS b,
    CASE s_nationkey % 4 WHEN 0 THEN 'the' WHEN 1 THEN 'der' WHEN 2 THEN 'la' ELSE 'el' END AS c FROM supplier),
  d AS (SELECT doc_id, lower(text) AS t FROM documents),
  m AS (SELECT doc_id, min(s_suppkey) AS first FROM d JOIN (SELECT b, c, min(s_suppkey) AS s_suppkey FROM rules GROUP BY 1, 2) r
    ON contains(t, r.b) AND contains(t, r.c) GROUP BY 1)
  SELECT doc_id, coalesce('rule ' || first, 'unknown') AS label FROM d LEFT JOIN m USING (doc_id)""")
def rule_table_text(spark, sf_dir):
    """A rule for each supplier, as a table: a number and one of four articles have to be in the text; the lowest key wins."""
    nation = F.col("s_nationkey") % 4
    article = F.when(nation == 0, "the").when(nation == 1, "der").when(nation == 2, "la").otherwise("el")
    rules = star.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("rule_order"), F.concat(F.lit("rule "), F.col("s_suppkey").cast("string")).alias("label"),
        F.posexplode(F.array((F.col("s_suppkey") % 97).cast("string"), article)).alias("word_group", "word"))
    docs = star.table(spark, sf_dir, "documents").select("doc_id", "text")
    return C.classify_by_table(docs, "text", rules).select("doc_id", "label")


# ---- scalar fields ---------------------------------------------------------------------------------
def _contract_texts(spark, sf_dir):
    c = star.contracts(spark, sf_dir)
    row = {n: F.col(n) for n in c.columns}
    return c.select(
        *c.columns, star.invitation_text(row).alias("invitation"), star.award_text(row).alias("award"),
        star.item_c_text(row, F.lit("")).alias("item_c"),
    )


@query("""SELECT contract_number, CASE WHEN k % 3 = 0 THEN 'DA99999' WHEN da THEN contract_number END AS invitation,
  CASE WHEN da THEN contract_number WHEN k % 3 = 0 THEN 'DA99999' END AS award,
  contract_number AS item_c, contract_number AS bid_tabs,
  CASE WHEN k % 3 = 0 THEN 'DA99999' ELSE contract_number END AS as_read FROM docs""")
def x_contract_number(spark, sf_dir):
    noise = F.when(F.col("k") % 3 == 0, F.lit("ref da99999x\n")).otherwise(F.lit("ref none\n"))
    text = F.concat(noise, F.lit("Contract No.: "), F.col("contract_number"), F.lit(" of record\n"))
    docs = star.contracts(spark, sf_dir).select("contract_number", text.alias("text"))
    kinds = {"invitation": S.INVITATION, "award": S.AWARD, "item_c": S.ITEM_C, "bid_tabs": S.BID_TABS, "as_read": S.AS_READ}
    return docs.select("contract_number", *(X.contract_number(kind, F.col("text")).alias(n) for n, kind in kinds.items()))


@query("SELECT contract_number, wbs_element AS invitation, wbs_element AS award FROM o")
def x_wbs(spark, sf_dir):
    return _contract_texts(spark, sf_dir).select(
        "contract_number", X.wbs_element(S.INVITATION, F.col("invitation")).alias("invitation"),
        X.wbs_element(S.AWARD, F.col("award")).alias("award"))


@query("SELECT contract_number, counties AS invitation, counties AS award FROM o")
def x_counties(spark, sf_dir):
    return _contract_texts(spark, sf_dir).select(
        "contract_number", X.counties(S.INVITATION, F.col("invitation")).alias("invitation"),
        X.counties(S.AWARD, F.col("award")).alias("award"))


@query("""SELECT contract_number, description AS invitation, description || ' and side roads' AS award FROM docs""")
def x_description(spark, sf_dir):
    return _contract_texts(spark, sf_dir).select(
        "contract_number", X.description(S.INVITATION, F.col("invitation")).alias("invitation"),
        X.description(S.AWARD, F.col("award")).alias("award"))


@query("""SELECT contract_number, CAST(date_available AS VARCHAR) AS invitation_available,
  CAST(completion_date AS VARCHAR) AS invitation_completion, CAST(date_available AS VARCHAR) AS item_c_available,
  CAST(completion_date AS VARCHAR) AS item_c_completion FROM o""")
def x_dates(spark, sf_dir):
    found = {
        "invitation_available": X.date_available(S.INVITATION, F.col("invitation")),
        "invitation_completion": X.completion_date(S.INVITATION, F.col("invitation")),
        "item_c_available": X.date_available(S.ITEM_C, F.col("item_c")),
        "item_c_completion": X.completion_date(S.ITEM_C, F.col("item_c")),
    }
    return _contract_texts(spark, sf_dir).select("contract_number", *(c.cast("string").alias(n) for n, c in found.items()))


@query("SELECT contract_number, mbe_goal, wbe_goal, combined_goal FROM o")
def x_goals(spark, sf_dir):
    names = ["mbe_goal", "wbe_goal", "combined_goal"]
    texts = _contract_texts(spark, sf_dir).select("contract_number", "invitation")
    return texts.select("contract_number", *(X.goal(n, F.col("invitation")).alias(n) for n in names))


@query("SELECT contract_number, strftime(bid_opening_date, '%Y-%m-%d %H:%M:%S') AS bid_opening_date FROM o")
def x_bid_opening(spark, sf_dir):
    return _contract_texts(spark, sf_dir).select(
        "contract_number", X.bid_opening_date(F.col("invitation")).cast("string").alias("bid_opening_date"))


@query("SELECT contract_number, awarded_to FROM o")
def x_awarded_to(spark, sf_dir):
    return _contract_texts(spark, sf_dir).select("contract_number", X.awarded_to(F.col("award")).alias("awarded_to"))


@query("SELECT contract_number, CAST(awarded_amount AS DOUBLE) AS awarded_amount FROM o")
def x_awarded_amount(spark, sf_dir):
    return _contract_texts(spark, sf_dir).select(
        "contract_number", X.awarded_amount(F.col("award")).cast(DOUBLE).alias("awarded_amount"))


@query("SELECT contract_number, CAST(award_date AS VARCHAR) AS award_date FROM o")
def x_award_date(spark, sf_dir):
    return _contract_texts(spark, sf_dir).select(
        "contract_number", X.award_date(F.col("award")).cast("string").alias("award_date"))


@query("""SELECT contract_number, proposal_length, type_of_work, location, CAST(estimated_cost AS DOUBLE) AS estimated_cost FROM o""")
def x_item_c_scalars(spark, sf_dir):
    t = F.col("item_c")
    return _contract_texts(spark, sf_dir).select(
        "contract_number", X.proposal_length(t).alias("proposal_length"), X.type_of_work(t).alias("type_of_work"),
        X.location(t).alias("location"), X.estimated_cost(t).cast(DOUBLE).alias("estimated_cost"))


@query("""SELECT doc_id, nullif(regexp_extract(text, '(?i)in the amount of\\s+\\$\\s*([\\d,]+\\.?\\d*)', 1), '') AS amount_text,
  nullif(regexp_extract(text, '(?i)([A-Za-z]+\\s+\\d{1,2},?\\s+\\d{4})', 1), '') AS date_text,
  nullif(regexp_extract(text, '([\\d,]+\\.\\d{2})', 1), '') AS money_text,
  len(regexp_extract_all(text, '[\\d,]+\\.\\d{2}')) AS money_tokens FROM documents""")
def raw_text_tokens(spark, sf_dir):
    """The same patterns over the raw documents, whole texts."""
    from ..functions.text import first_match, rx

    t = F.col("text")
    return star.table(spark, sf_dir, "documents").select(
        "doc_id",
        first_match(t, (rx(rf"in the amount of\s+\$\s*({X.MONEY})", "i"), 1)).alias("amount_text"),
        first_match(t, (rx(rf"({X.MONTH_DAY_YEAR})", "i"), 1)).alias("date_text"),
        first_match(t, (rx(rf"({G.AMOUNT})"), 1)).alias("money_text"),
        F.size(F.regexp_extract_all(t, F.lit(G.PRICE), F.lit(0))).cast("bigint").alias("money_tokens"),
    )


# ---- pages -----------------------------------------------------------------------------------------
@query("""SELECT doc_id, string_agg(text, chr(10) ORDER BY page_no) || chr(10) AS text
  FROM p GROUP BY 1""")
def assemble_text(spark, sf_dir):
    return P.assemble_text(star.pages(spark, sf_dir))


@query("""SELECT doc_id, max(CASE WHEN page_no = 5 THEN text END) AS text,
  CASE WHEN NOT bool_or(page_no = 5) THEN 'Page 5 does not exist' END AS error FROM p GROUP BY 1""")
def page_text(spark, sf_dir):
    return P.page_text(star.pages(spark, sf_dir), 5)


@query("""SELECT doc_id, page_no, CASE WHEN NOT blank THEN text WHEN page_no % 2 = 0 THEN role ELSE '' END AS text FROM p""")
def text_fallback(spark, sf_dir):
    """Own text, else the speaker on even turns, else the last candidate even though it is empty."""
    pages = star.pages(spark, sf_dir)
    second = F.when(F.col("page_no") % 2 == 0, F.col("role")).otherwise(F.lit("\t"))
    return pages.select(
        "doc_id", F.col("page_no").cast("bigint").alias("page_no"), P.first_nonblank(F.col("text"), second, F.lit("")).alias("text"))


@query("""SELECT doc_id, CAST(coalesce(sum(CASE WHEN NOT blank THEN length(text) END), 0) AS BIGINT) AS text_length,
  count(*) FILTER (NOT blank) AS text_pages_with_content, count(*) AS text_page_count FROM p GROUP BY 1""")
def text_stats(spark, sf_dir):
    return P.text_stats(star.pages(spark, sf_dir))
