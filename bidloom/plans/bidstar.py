"""Bid concepts derived from the star-schema tables, and documents written out from them.

orders are contracts, suppliers (folded into 26 bidding houses) are bidders, lineitems are bid items, events
are the run log, conversations are page tables, documents are raw texts and files. Every group that is
collected here is bounded by construction: at most 26 houses per contract and 10,000 item numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S

COUNTIES = ["Wake", "Dare and Hyde", "Pitt", "Bertie", "Gates & Hertford"]
PLACES = ["WILSON, NC", "DURHAM, NC", "EDENTON, VA", "RALEIGH, NC"]
UNITS = {"A": "EA", "N": "Lump Sum", "R": "TON"}
LABELS = ["Invitation to Bid", "Bid Tabs", "Award Letter", "Item C Report", "Bid Summary", "Bids As Read", "Other"]
EVENT_TYPES = {
    "click": S.INVITATION, "error": S.ITEM_C, "purchase": S.AWARD, "signup": S.BID_TABS, "view": S.SUMMARY,
}
MTIME = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def contract_key(k: Column) -> Column:
    digits = k.cast("string")
    return F.when((k % 10 == 0) | (k >= 100000), F.lpad(digits, 8, "0")).otherwise(
        F.concat(F.lit("DA"), F.lpad(digits, 5, "0"))
    )


def _pick(values: list[str], at: Column) -> Column:
    return F.get(F.array(*(F.lit(v) for v in values)), at.cast("int"))


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One contract per order; award amount is the order total."""
    k = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    shift = lambda n: F.date_add(day, n.cast("int"))
    price = F.col("o_totalprice").cast("decimal(15,2)")
    opening = F.concat(
        shift(k % 40).cast("string"), F.when(k % 2 == 0, F.lit(" 14:00:00")).otherwise(F.lit(" 10:30:00"))
    )
    mbe, wbe = (k % 8 + 1).cast("double"), (k % 5) + F.lit(0.5)
    return table(spark, sf_dir, "orders").select(
        k.alias("k"),
        contract_key(k).alias("contract_number"),
        F.concat(F.lit("17BP.1.R."), F.col("o_custkey").cast("string")).alias("wbs_element"),
        _pick(COUNTIES, F.col("o_custkey") % 5).alias("counties"),
        F.concat(F.lit("Resurfacing of route "), F.col("o_custkey").cast("string")).alias("description"),
        shift(F.lit(30)).alias("date_available"),
        shift(k % 400 + 10).alias("completion_date"),
        opening.cast("timestamp_ntz").alias("bid_opening_date"),
        shift(k % 25 + 5).alias("award_date"),
        mbe.alias("mbe_goal"),
        wbe.alias("wbe_goal"),
        F.when(k % 11 != 0, mbe + wbe - F.when(k % 3 == 0, 1.0).otherwise(0.0)).alias("combined_goal"),
        F.concat((k % 90).cast("string"), F.lit(".25")).cast("double").alias("proposal_length"),
        F.concat(F.lit("GRADING AND "), F.upper(F.col("o_orderstatus")), F.lit(" PAVING")).alias("type_of_work"),
        F.concat(F.lit("US "), (k % 300).cast("string"), F.lit(" NEAR MANTEO")).alias("location"),
        price.alias("estimated_cost"),
        F.when(k % 9 != 4, price).alias("awarded_amount"),
        F.concat(F.lit("Acme Builders "), (k % 50).cast("string")).alias("awarded_to"),
    )


def house() -> Column:
    return F.pmod(F.col("l_suppkey"), F.lit(26)).cast("int")


def house_name(h: Column) -> Column:
    letter = F.chr(h + 65)
    return F.concat(F.lit("ACME "), letter, letter, F.lit(" INC"))


def bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, house, total): bids of a contract, at most 26; sums combine before the shuffle."""
    price = F.col("l_extendedprice").cast("decimal(15,2)")
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k"), house().alias("house")).agg(
        F.sum(price).cast("decimal(15,2)").alias("total")
    )


def bidders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bids with rank by amount, percent over the low bid and an occasional winner flag."""
    by_amount = Window.partitionBy("k").orderBy("total", "house")
    cents = lambda c: (c * 100).cast("bigint")
    ranked = bids(spark, sf_dir).select(
        "k", "house", "total", F.row_number().over(by_amount).alias("bid_rank"), F.min("total").over(Window.partitionBy("k")).alias("low")
    )
    tenths = F.expr("(cast(total * 100 as bigint) - cast(low * 100 as bigint)) * 1000 div cast(low * 100 as bigint)")
    return ranked.select(
        "k",
        contract_key(F.col("k")).alias("contract_number"),
        F.col("house").alias("position"),
        house_name(F.col("house")).alias("bidder_name"),
        _pick(PLACES, F.col("house") % 4).alias("bidder_location"),
        F.col("total").alias("total_bid_amount"),
        "bid_rank",
        tenths.alias("tenths"),
        (tenths / 10.0).alias("percentage_diff"),
        ((F.col("k") % 7 == 3) & (F.col("bid_rank") == 2)).alias("is_winner"),
    )


def awarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts whose award is, for every second one, the low bid instead of the order total."""
    low = bids(spark, sf_dir).groupBy("k").agg(F.min("total").alias("_low"))
    return contracts(spark, sf_dir).join(low, "k", "left").withColumn(
        "awarded_amount",
        F.when((F.col("k") % 2 == 0) & (F.col("k") % 9 != 4), F.col("_low")).otherwise(F.col("awarded_amount")),
    ).drop("_low")


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lineitem as a priced item of its house; line 7 is left unpriced."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"),
        contract_key(F.col("l_orderkey")).alias("contract_number"),
        house_name(house()).alias("bidder_name"),
        F.when(F.col("l_linenumber") != 7, F.col("l_extendedprice").cast("decimal(15,2)")).alias("total_price"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One item per contract and line number."""
    slot = F.pmod(F.col("l_linenumber"), F.lit(10000)).cast("int")
    dec = lambda c: F.col(c).cast("decimal(15,2)")
    grouped = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k"), slot.alias("slot")).agg(
        F.sum(dec("l_quantity")).cast("decimal(15,2)").alias("quantity"),
        F.sum(dec("l_extendedprice")).cast("decimal(15,2)").alias("total_price"),
        F.min(dec("l_extendedprice")).alias("unit_price"),
        F.min("l_partkey").alias("part"),
        F.min("l_returnflag").alias("flag"),
    )
    unit = F
    for flag, name in UNITS.items():
        unit = unit.when(F.col("flag") == flag, F.lit(name))
    return grouped.select(
        "k",
        contract_key(F.col("k")).alias("contract_number"),
        F.col("slot").alias("position"),
        F.lpad(F.col("slot").cast("string"), 4, "0").alias("item_number"),
        F.concat(F.lit("P"), F.col("part").cast("string")).alias("item_code"),
        F.concat(F.lit("Item of part "), F.col("part").cast("string")).alias("description"),
        "quantity",
        unit.alias("unit"),
        "unit_price",
        "total_price",
    )


# ---- text of single lines -----------------------------------------------------------------------------
def money(c: Column) -> Column:
    return F.format_number(c, 2)


def percent(tenths: Column) -> Column:
    return F.format_string("%d.%d", F.floor(tenths / 10), tenths % 10)


def as_read_line(b) -> Column:
    return F.concat_ws(" ", b["bidder_name"], b["bidder_location"], money(b["total_bid_amount"]), b["bid_rank"].cast("string"))


def summary_line(b) -> Column:
    return F.concat_ws(
        " ", b["bid_rank"].cast("string"), b["bidder_name"], b["bidder_location"], money(b["total_bid_amount"]), percent(b["tenths"])
    )


def item_c_line(b) -> Column:
    return F.concat_ws(" ", b["bidder_name"], F.lit(""), b["bidder_location"], money(b["total_bid_amount"]), percent(b["tenths"]))


def bid_tab_line(b) -> Column:
    """Every fifth house has no total of its own and takes the next one in the document."""
    total = F.concat(F.lit("\nCONTRACT TOTAL "), money(b["total_bid_amount"]))
    return F.concat(
        b["bidder_name"], F.lit(" "), b["bidder_location"], F.when(b["position"] % 5 == 0, F.lit("")).otherwise(total)
    )


def section_line(b) -> Column:
    return F.concat(money(b["total_bid_amount"]), b["bidder_name"], F.lit(" "), b["bid_rank"].cast("string"))


def item_line(i) -> Column:
    return F.concat_ws(
        " ", i["item_number"], i["item_code"], money(i["quantity"]), i["description"], i["unit"], money(i["unit_price"]),
        money(i["total_price"]),
    )


def long_date(d: Column) -> Column:
    return F.date_format(d, "MMMM d, yyyy")


def short_date(d: Column) -> Column:
    return F.upper(F.date_format(d, "MMM dd yyyy"))


# ---- whole documents ------------------------------------------------------------------------------------
def invitation_text(c) -> Column:
    return F.concat(
        F.lit("NOTICE TO PROSPECTIVE BIDDERS\nSealed proposals for the project in Division One:\n"),
        c["contract_number"], F.lit(" - "), c["description"], F.lit("\n\nWBS Element: "), c["wbs_element"],
        F.lit("\nThis project is located in "), c["counties"], F.lit(" Counties.\nDescription: "), c["description"],
        F.lit("\nThe Date of Availability for this contract is "), long_date(c["date_available"]),
        F.lit(".\nThe Completion Date for this contract is "), long_date(c["completion_date"]),
        F.lit(".\nMinority Business Enterprise Goal = "), c["mbe_goal"].cast("string"),
        F.lit("%\nWBE Goal = "), c["wbe_goal"].cast("string"), F.lit("%\n"),
        F.coalesce(F.concat(F.lit("Combined MBE/WBE Goal = "), c["combined_goal"].cast("string"), F.lit("%\n")), F.lit("")),
        F.lit("The Bid Opening will be at "), F.lower(F.date_format(c["bid_opening_date"], "h:mm a")), F.lit(" on Tuesday "),
        long_date(c["bid_opening_date"].cast("date")), F.lit(" in Edenton.\n"),
    )


def award_text(c) -> Column:
    return F.concat(
        F.lit("NOTIFICATION OF AWARD "), long_date(c["award_date"]), F.lit("\nContract No. "), c["contract_number"],
        F.lit("\nWBS Element: "), c["wbs_element"], F.lit("\nCounty: "), c["counties"], F.lit("\nDescription: "),
        c["description"], F.lit("\nand side roads\nDear Sir/Madam: We are pleased to inform you that "), c["awarded_to"],
        F.lit("\nP.O. Box 12 has been awarded the contract"),
        F.coalesce(F.concat(F.lit(" in the amount of $ "), money(c["awarded_amount"])), F.lit("")), F.lit(".\n"),
    )


def item_c_text(c, lines: Column) -> Column:
    return F.concat(
        c["contract_number"], F.lit("\nitem c: $ totals and % diff\nPROPOSAL LENGTH "), c["proposal_length"].cast("string"),
        F.lit(" MILES\nTYPE OF WORK "), c["type_of_work"], F.lit("\nLOCATION "), c["location"], F.lit("\nESTIMATE "),
        money(c["estimated_cost"]), F.lit("\nDATE AVAILABLE "), short_date(c["date_available"]),
        F.lit("\nFINAL COMPLETION "), short_date(c["completion_date"]), F.lit("\n"), lines, F.lit("\n"),
    )


def lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts with their bidders and items as sorted arrays."""
    bid = F.struct(
        "position", "bidder_name", "bidder_location", "total_bid_amount", "bid_rank", "tenths"
    )
    item = F.struct(
        "position", "item_number", "item_code", "description", "quantity", "unit", "unit_price", "total_price"
    )
    per_bid = bidders(spark, sf_dir).groupBy("k").agg(F.array_sort(F.collect_list(bid)).alias("bids"))
    per_item = items(spark, sf_dir).groupBy("k").agg(F.array_sort(F.collect_list(item)).alias("items"))
    joined = contracts(spark, sf_dir).join(per_bid, "k", "left").join(per_item, "k", "left")
    return joined.withColumn("bids", F.coalesce("bids", F.array())).withColumn("items", F.coalesce("items", F.array()))


def _joined(array: str, line, sep: str = "\n") -> Column:
    return F.array_join(F.transform(array, line), sep)


def bidder_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts with one text per bidder-bearing document type."""
    row = {c: F.col(c) for c in ("contract_number", "proposal_length", "type_of_work", "location", "estimated_cost",
                                 "date_available", "completion_date")}
    per_bid = bidders(spark, sf_dir).groupBy("k").agg(F.array_sort(F.collect_list(F.struct(
        "position", "bidder_name", "bidder_location", "total_bid_amount", "bid_rank", "tenths"))).alias("bids"))
    return contracts(spark, sf_dir).join(per_bid, "k").select(
        "k", "contract_number", "bids",
        F.concat(F.lit("BIDS AS READ\n"), _joined("bids", as_read_line)).alias(S.AS_READ),
        F.concat(F.lit("BID SUMMARY\n"), _joined("bids", summary_line)).alias(S.SUMMARY),
        item_c_text(row, _joined("bids", item_c_line)).alias(S.ITEM_C),
        F.concat(F.lit("roadway items, contractor list\n"), F.col("contract_number"), F.lit(".\n"), _joined("bids", bid_tab_line)).alias(S.BID_TABS),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per contract, of the type its key picks, ready for `process_documents`.

    Every 13th leaves its key out of the text, every 17th has no text, every second "Other" file tells its
    type on the first page.
    """
    c = lists(spark, sf_dir)
    k = F.col("k")
    row = {name: F.col(name) for name in c.columns}
    shown = dict(row, contract_number=F.when(k % 13 == 0, F.lit("(see file)")).otherwise(F.col("contract_number")))
    key_line = F.concat(F.lit("Contract "), shown["contract_number"], F.lit("\n"))
    as_read = F.concat(F.lit("Bids as read\n"), key_line, _joined("bids", as_read_line))
    text = (
        F.when(k % 17 == 0, F.lit(""))
        .when(k % 7 == 0, invitation_text(shown))
        .when(k % 7 == 1, F.concat(F.lit("roadway items, contractor list\n"), shown["contract_number"], F.lit(".\n"),
                                   _joined("bids", bid_tab_line), F.lit("\n\n"), _joined("items", item_line)))
        .when(k % 7 == 2, award_text(shown))
        .when(k % 7 == 3, item_c_text(shown, _joined("bids", item_c_line)))
        .when(k % 7 == 4, F.concat(F.lit("BID SUMMARY\n"), key_line, _joined("bids", summary_line)))
        .when((k % 7 == 5) | (k % 2 == 0), as_read)
        .otherwise(F.concat(F.lit("Minutes of the meeting on "), F.col("description")))
    )
    return c.select(
        "k",
        F.concat(F.lit("landing/"), F.col("contract_number"), F.lit("_"), _pick(LABELS, k % 7), F.lit(".pdf")).alias("file_path"),
        text.alias("text"),
    ).select(
        "k", "file_path", "text",
        F.col("text").alias("first_page"),
        F.length("text").cast("bigint").alias("text_length"),
        F.when(F.length("text") > 0, 1).otherwise(0).cast("bigint").alias("pages_with_content"),
        F.lit(1).cast("bigint").alias("page_count"),
        F.sha2("text", 256).alias("file_hash"),
        F.length("text").cast("bigint").alias("file_size_bytes"),
        F.lit(MTIME).cast("timestamp_ntz").alias("file_mtime"),
    )


# ---- logs, pages, files -------------------------------------------------------------------------------
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as results of past runs."""
    e = table(spark, sf_dir, "events")
    return log_of(e)


def log_of(events: DataFrame) -> DataFrame:
    kind = F
    for name, doc_type in EVENT_TYPES.items():
        kind = kind.when(F.col("event_type") == name, F.lit(doc_type))
    status = (
        F.when(F.col("event_type") == "error", "failed")
        .when(F.col("event_type") == "view", "skipped")
        .when((F.col("event_type") == "click") & (F.col("event_id") % 2 == 1), "partial")
        .otherwise("success")
    )
    error = F.when(F.col("event_type") == "error", F.concat(F.lit("parse error "), (F.col("user_id") % 5).cast("string"))).when(
        F.col("event_type") == "view", F.lit("unchanged")
    )
    return events.select(
        F.concat(F.lit("run/"), F.col("event_id").cast("string"), F.lit(".pdf")).alias("file_path"),
        F.col("ts").cast("timestamp").alias("ts"),
        kind.alias("document_type"),
        status.alias("status"),
        error.alias("error"),
        F.when(F.col("event_type") != "view", F.col("value").cast("decimal(10,2)")).alias("processing_time"),
        ((F.col("event_id") % 11) / 10.0).cast("decimal(5,4)").alias("completeness"),
        F.col("user_id").alias("run"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as page tables; every fifth page is blank."""
    blank = (F.col("conv_id") + F.col("turn")) % 5 == 0
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("doc_id"),
        F.col("turn").cast("int").alias("page_no"),
        F.when(blank, F.lit(" \n ")).otherwise(F.col("text")).alias("text"),
        "role",
    )


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw documents as files with a fingerprint."""
    d = F.col("doc_id").cast("string")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(F.col("source"), F.lit("/"), d, F.lit("_"), _pick(LABELS, F.col("doc_id") % 7), F.lit(".pdf")).alias("file_path"),
        F.sha2("text", 256).alias("file_hash"),
        F.col("n_chars").alias("file_size_bytes"),
        F.lit(MTIME).cast("timestamp_ntz").alias("file_mtime"),
    )


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of an earlier run: the labelled documents; poor ones have another hash, toxic ones an older time."""
    seen = files(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    return seen.select(
        "file_path",
        F.when(F.col("quality") == 0, F.lit("0")).otherwise(F.col("file_hash")).alias("file_hash"),
        "file_size_bytes",
        F.when(F.col("toxic") == 1, F.lit("2023-01-01 00:00:00")).otherwise(F.lit(MTIME)).cast("timestamp_ntz").alias("file_mtime"),
    )
