"""Named queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name; `sql` is appended to the shared derivations."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql if sql.lstrip().upper().startswith("WITH") else f"{STAR}\n{sql}"
        return fn

    return register


# The derivations of bidstar.py in SQL. Unused ones cost nothing.
STAR = """
WITH o AS (
  SELECT o_orderkey AS k,
    CASE WHEN o_orderkey % 10 = 0 OR o_orderkey >= 100000 THEN lpad(CAST(o_orderkey AS VARCHAR), 8, '0')
         ELSE 'DA' || lpad(CAST(o_orderkey AS VARCHAR), 5, '0') END AS contract_number,
    '17BP.1.R.' || o_custkey AS wbs_element,
    ['Wake', 'Dare and Hyde', 'Pitt', 'Bertie', 'Gates & Hertford'][CAST(o_custkey % 5 AS INTEGER) + 1] AS counties,
    'Resurfacing of route ' || o_custkey AS description,
    CAST(o_orderdate AS DATE) AS d,
    CAST(o_orderdate AS DATE) + 30 AS date_available,
    CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 + 10 AS INTEGER) AS completion_date,
    CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INTEGER) AS TIMESTAMP)
      + CASE WHEN o_orderkey % 2 = 0 THEN INTERVAL 840 MINUTE ELSE INTERVAL 630 MINUTE END AS bid_opening_date,
    CAST(o_orderdate AS DATE) + CAST(o_orderkey % 25 + 5 AS INTEGER) AS award_date,
    CAST(o_orderkey % 8 + 1 AS DOUBLE) AS mbe_goal,
    CAST(o_orderkey % 5 AS DOUBLE) + 0.5 AS wbe_goal,
    CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderkey % 8 + 1 AS DOUBLE) + CAST(o_orderkey % 5 AS DOUBLE) + 0.5
      - CASE WHEN o_orderkey % 3 = 0 THEN 1.0 ELSE 0.0 END END AS combined_goal,
    CAST((o_orderkey % 90) || '.25' AS DOUBLE) AS proposal_length,
    'GRADING AND ' || upper(o_orderstatus) || ' PAVING' AS type_of_work,
    'US ' || (o_orderkey % 300) || ' NEAR MANTEO' AS location,
    CAST(o_totalprice AS DECIMAL(15,2)) AS estimated_cost,
    CASE WHEN o_orderkey % 9 <> 4 THEN CAST(o_totalprice AS DECIMAL(15,2)) END AS awarded_amount,
    'Acme Builders ' || (o_orderkey % 50) AS awarded_to,
    o_orderstatus
  FROM orders),
bt AS (
  SELECT l_orderkey AS k, CAST(l_suppkey % 26 AS INTEGER) AS house,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(15,2)) AS total
  FROM lineitem GROUP BY 1, 2),
b AS (
  SELECT k,
    CASE WHEN k % 10 = 0 OR k >= 100000 THEN lpad(CAST(k AS VARCHAR), 8, '0')
         ELSE 'DA' || lpad(CAST(k AS VARCHAR), 5, '0') END AS contract_number,
    house, 'ACME ' || chr(65 + house) || chr(65 + house) || ' INC' AS bidder_name,
    ['WILSON, NC', 'DURHAM, NC', 'EDENTON, VA', 'RALEIGH, NC'][house % 4 + 1] AS bidder_location,
    total AS total_bid_amount,
    CAST(row_number() OVER (PARTITION BY k ORDER BY total, house) AS INTEGER) AS bid_rank,
    CAST(row_number() OVER (PARTITION BY k ORDER BY house) AS INTEGER) AS ordinal,
    (CAST(total * 100 AS BIGINT) - CAST(min(total) OVER (PARTITION BY k) * 100 AS BIGINT)) * 1000
      // CAST(min(total) OVER (PARTITION BY k) * 100 AS BIGINT) AS tenths,
    k % 7 = 3 AND row_number() OVER (PARTITION BY k ORDER BY total, house) = 2 AS is_winner,
    first_value(CASE WHEN house % 5 <> 0 THEN total END IGNORE NULLS) OVER (PARTITION BY k ORDER BY house
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_total
  FROM bt),
low AS (SELECT k, min(total) AS low_bid FROM bt GROUP BY k),
aw AS (
  SELECT o.* EXCLUDE (awarded_amount),
    CASE WHEN o.k % 2 = 0 AND o.k % 9 <> 4 THEN low_bid ELSE awarded_amount END AS awarded_amount
  FROM o LEFT JOIN low USING (k)),
li AS (
  SELECT l_orderkey AS k,
    CASE WHEN l_orderkey % 10 = 0 OR l_orderkey >= 100000 THEN lpad(CAST(l_orderkey AS VARCHAR), 8, '0')
         ELSE 'DA' || lpad(CAST(l_orderkey AS VARCHAR), 5, '0') END AS contract_number,
    'ACME ' || chr(65 + CAST(l_suppkey % 26 AS INTEGER)) || chr(65 + CAST(l_suppkey % 26 AS INTEGER)) || ' INC' AS bidder_name,
    CASE WHEN l_linenumber <> 7 THEN CAST(l_extendedprice AS DECIMAL(15,2)) END AS total_price
  FROM lineitem),
it AS (
  SELECT k, contract_number, slot AS position, lpad(CAST(slot AS VARCHAR), 4, '0') AS item_number,
    'P' || part AS item_code, 'Item of part ' || part AS description, quantity,
    CASE flag WHEN 'A' THEN 'Ea' WHEN 'N' THEN 'Lump Sum' ELSE 'Ton' END AS unit,
    CASE flag WHEN 'A' THEN 'EA' WHEN 'N' THEN 'Lump Sum' ELSE 'TON' END AS raw_unit, unit_price, total_price
  FROM (SELECT l_orderkey AS k,
          CASE WHEN l_orderkey % 10 = 0 OR l_orderkey >= 100000 THEN lpad(CAST(l_orderkey AS VARCHAR), 8, '0')
               ELSE 'DA' || lpad(CAST(l_orderkey AS VARCHAR), 5, '0') END AS contract_number,
          CAST(l_linenumber % 10000 AS INTEGER) AS slot, sum(CAST(l_quantity AS DECIMAL(15,2))) AS quantity,
          sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS total_price,
          min(CAST(l_extendedprice AS DECIMAL(15,2))) AS unit_price, min(l_partkey) AS part, min(l_returnflag) AS flag
        FROM lineitem GROUP BY 1, 2, 3)),
docs AS (
  SELECT o.*, k % 7 AS t,
    'landing/' || contract_number || '_' || ['Invitation to Bid', 'Bid Tabs', 'Award Letter', 'Item C Report',
      'Bid Summary', 'Bids As Read', 'Other'][CAST(k % 7 AS INTEGER) + 1] || '.pdf' AS file_path,
    CASE k % 7 WHEN 0 THEN 'invitation_to_bid' WHEN 1 THEN 'bid_tabs' WHEN 2 THEN 'award_letter' WHEN 3 THEN 'item_c_report'
      WHEN 4 THEN 'bid_summary' WHEN 5 THEN 'bids_as_read'
      ELSE CASE WHEN k % 17 <> 0 AND k % 2 = 0 THEN 'bids_as_read' ELSE 'unknown' END END AS document_type,
    k % 17 = 0 AS empty,
    contract_number LIKE 'DA%' AS da
  FROM o),
dk AS (
  -- key as extracted and repaired: an empty or key-less text leaves only a DA key of the file name
  SELECT docs.*,
    CASE WHEN document_type = 'unknown' THEN NULL
         WHEN da THEN contract_number
         WHEN empty OR k % 13 = 0 THEN NULL
         WHEN t IN (0, 2) THEN NULL
         ELSE contract_number END AS found_key
  FROM docs),
nb AS (SELECT k, count(*) AS bids FROM bt GROUP BY k),
ni AS (SELECT k, count(*) AS items FROM it GROUP BY k),
rs AS (
  -- results of the document plan
  SELECT dk.*, bids,
    CASE WHEN document_type = 'unknown' THEN 'skipped' WHEN empty OR found_key IS NULL
           OR (t IN (1, 4, 5, 6) AND bids IS NULL) THEN 'partial'
         ELSE 'success' END AS status,
    CASE WHEN document_type = 'unknown' OR empty OR t IN (0, 2) THEN 0
         WHEN t = 3 THEN coalesce(bids, 0) + 2 ELSE coalesce(bids, 0) END AS n_bidders,
    CASE WHEN t = 1 AND NOT empty THEN coalesce(items, 0) ELSE 0 END AS n_items
  FROM dk LEFT JOIN nb USING (k) LEFT JOIN ni USING (k)),
r AS (
  SELECT 'run/' || event_id || '.pdf' AS file_path, event_id, ts,
    CASE event_type WHEN 'click' THEN 'invitation_to_bid' WHEN 'error' THEN 'item_c_report' WHEN 'purchase' THEN 'award_letter'
      WHEN 'signup' THEN 'bid_tabs' WHEN 'view' THEN 'bid_summary' END AS document_type,
    CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'view' THEN 'skipped'
      WHEN event_type = 'click' AND event_id % 2 = 1 THEN 'partial' ELSE 'success' END AS status,
    CASE WHEN event_type = 'error' THEN 'parse error ' || (user_id % 5) WHEN event_type = 'view' THEN 'unchanged' END AS error,
    CASE WHEN event_type <> 'view' THEN CAST(value AS DECIMAL(10,2)) END AS processing_time,
    CAST((event_id % 11) / 10.0 AS DECIMAL(5,4)) AS completeness, user_id AS run
  FROM events),
p AS (
  SELECT conv_id AS doc_id, turn AS page_no,
    CASE WHEN (conv_id + turn) % 5 = 0 THEN ' ' || chr(10) || ' ' ELSE text END AS text,
    (conv_id + turn) % 5 = 0 AS blank, role
  FROM conversations),
f AS (
  SELECT doc_id, source || '/' || doc_id || '_' || ['Invitation to Bid', 'Bid Tabs', 'Award Letter', 'Item C Report',
      'Bid Summary', 'Bids As Read', 'Other'][CAST(doc_id % 7 AS INTEGER) + 1] || '.pdf' AS file_path,
    sha256(text) AS file_hash, n_chars AS file_size_bytes, TIMESTAMP '2024-01-01 00:00:00' AS file_mtime
  FROM documents),
st AS (
  SELECT file_path, CASE WHEN quality = 0 THEN '0' ELSE file_hash END AS file_hash, file_size_bytes,
    CASE WHEN toxic = 1 THEN TIMESTAMP '2023-01-01 00:00:00' ELSE file_mtime END AS file_mtime
  FROM f JOIN labels USING (doc_id))
"""
