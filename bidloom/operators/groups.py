"""Repeating groups (bidders, bid items) found in document text.

Two forms share the same line and match parsers:
* in-row: one array per document, no shuffle at all (used by the document plan);
* long: one row per line of a page table, for documents too long to be one cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.parse import parse_int, parse_money, parse_number, parse_quantity, percent_in
from ..functions.ranks import running_count
from ..functions.text import (
    blank_to_null, capture_line, captures, let, located_captures, running_states, rx, squeeze, strip, text_lines, unmarked,
)

# ---- fixed values: line patterns ----------------------------------------------------------------------
NAME = r"[A-Z][A-Z0-9&.,'\- ]{3,}"
AMOUNT = r"[\d,]+\.\d{2}"
TOTAL = r"(?:CONTRACT\s+)?TOTAL\s+([\d,]+\.?\d*)"
RANK_SECTION = r"\A(?>.*?BIDDERS IN ORDER)(?>.*?CONTRACT TOTAL)(.*?)(?:\n\n|\z)"
# Finds what [\d,]+\.?\d*\s*[A-Z\s&]+(?:INC|LLC)?\s+(\d+) finds: the first stretch of letters behind a number
# that ends in a blank before a digit. Only the end of the number matters, so it is looked back at.
RANK_LINE = r"(?<=[\d,]|[\d,]\.)[A-Z\s&]++(?<=[A-Z\s&]\s)(\d+)"
ITEM_LINE = r"^(\d{4})\s+(\S+)\s+([\d,]+(?:\.\d+)?)\s+(.+)$"
HEADER_WORDS = {
    S.AS_READ: ["BIDS AS READ", "BID SUMMARY", "CONTRACT", "TOTAL", "ENGINEER", "BIDDER", "BIDDERS"],
    S.SUMMARY: ["BID SUMMARY", "CONTRACT", "TOTAL", "ENGINEER", "BIDDER", "BIDDERS", "SUMMARY"],
}
UNITS = ["LUMP SUM", "LS", "EA", "TON", "LF", "SY", "CY", "HR", "DAY", "MI", "GAL"]
TABLE_WORDS = ["item", "description", "quantity", "unit", "price", "total"]

# A place is published as [A-Z][A-Z .\-]+,\s*[A-Z]{2}. A name takes as much of the line as it can, so the place begins at the last word that can begin one. Seen from
# there the later words of a place start with a dot or a dash, or are one letter before the comma. Written so, no
# word is looked at from more than one split, whatever the line holds.
_PLACE = r"[A-Z](?!,)[A-Z.\-]*+(?: [.\-][A-Z.\-]*+)*+(?: [A-Z]?(?=,))?+,\s*[A-Z]{2}"
# After an amount the name takes the rest of the line, place included, so no place is ever split off.
_AMOUNT_FIRST = (rf"^({AMOUNT})\s+({NAME}+)$", (2, 0, 1, 0, 0))
#: Patterns in order of trial with the groups (name, place, amount, rank, percent). Lines come squeezed, the
#: only whitespace in them is the space, so the slower Unicode classes are not needed here.
LINE_PATTERNS = {
    S.AS_READ: [
        (rf"^({NAME})\s+({_PLACE})\s+({AMOUNT})(?:\s+(\d+))?$", (1, 2, 3, 4, 0)),
        _AMOUNT_FIRST,
    ],
    S.SUMMARY: [
        (
            rf"^(\d+)\s+({NAME})\s+({_PLACE})\s+({AMOUNT})(?:\s+([-+]?\d+(?:\.\d+)?))?%?$",
            (2, 3, 4, 1, 5),
        ),
        (rf"^({NAME})\s+({_PLACE})\s+({AMOUNT})\s+(\d+)$", (1, 2, 3, 4, 0)),
        _AMOUNT_FIRST,
    ],
}

# Over a whole text the pattern
#   ([A-Z][A-Z\s&]+(?:INC|LLC|CO)?)\s+([A-Z\s,]+)\s+([\d,]+\.?\d*)\s+([-+]?\d+\.?\d*)
# costs the cube of the length of an upper-case stretch. The form below finds the same matches in one
# pass. In a stretch of [A-Z\s&,] that ends in two numbers (first lookahead): a match cannot start before
# the last comma that an & follows (skipped at once), it starts at the first letter after a comma or at
# the stretch's beginning, and its name reaches at least to the last &.
ITEM_C_BIDDER = rx(
    r"(?<![A-Z\s&,])(?=[A-Z\s&,]*(?<=\s)[\d,]++\.?+\d*+\s++[-+]?\d)"
    r"(?:[A-Z\s&,]*,(?=[A-Z\s]*+&))?+[A-Z\s&,]*?(?<![A-Z\s&])[\s&]*+"
    r"([A-Z](?:(?>[A-Z\s&]*&)[A-Z\s]*|(?![A-Z\s]*+&)[A-Z\s]+))"
    r"\s+([A-Z\s,]+)\s+([\d,]+\.?\d*)\s+([-+]?\d+\.?\d*)"
)
# Likewise for ([A-Z][A-Z\s&]+(?:INC|LLC|CO)?)\s+([A-Z]+,\s*[A-Z]{2}): a match starts at the first
# letter of a comma-free stretch, or where the previous match has ended.
BID_TAB_BIDDER = rx(r"(?:\G|(?<![A-Z\s&]))[\s&]*+(?=[A-Z\s&]*+,)([A-Z][A-Z\s&]+)\s+([A-Z]+,\s*[A-Z]{2})")
# A price found anywhere in a token; digits are entered at their first position or after a match.
PRICE = rx(rf"(?:\G|(?<![\d,]))[\d,]++\.\d{{2}}")


def _bidder(name, place, amount, rank, percent) -> Column:
    return F.struct(
        name.alias("bidder_name"),
        place.alias("bidder_location"),
        amount.alias("total_bid_amount"),
        rank.cast("int").alias("bid_rank"),
        percent.cast("double").alias("percentage_diff"),
        F.lit(None).cast("boolean").alias("is_winner"),
    )


# ---- bidder lines ------------------------------------------------------------------------------------
def is_header_line(kind: str, line: Column) -> Column:
    return line.rlike("|".join(HEADER_WORDS[kind]))


def bidder_fields(kind: str, line: Column) -> Column:
    """Captured texts (name, place, amount, rank, percent, line); a single part if the line is no bid."""
    keep = (line != "") & ~is_header_line(kind, line)
    parts = capture_line(line, *LINE_PATTERNS[kind])
    return F.when(keep, let(parts, lambda p: F.when(F.size(p) > 1, F.array_append(p, line))))


def bidder_from_fields(kind: str, part: Column) -> Column:
    percent = (
        F.nullif(parse_number(F.replace(part[4], F.lit("%"), F.lit(""))), F.lit(0.0))
        if kind == S.SUMMARY
        else percent_in(part[5])
    )
    return _bidder(
        strip(part[0]), blank_to_null(strip(part[1])), parse_money(part[2]), parse_int(part[3]), percent
    )


def located_bidders(kind: str, text: Column) -> Column:
    """Accepted lines in order as array<struct(line_no, b)>."""
    parts = F.filter(
        F.transform(
            F.transform(text_lines(text), squeeze),
            lambda l, i: F.struct(i.alias("line_no"), bidder_fields(kind, l).alias("part")),
        ),
        lambda p: p["part"].isNotNull(),
    )
    parsed = F.transform(
        parts, lambda p: F.struct(p["line_no"].alias("line_no"), bidder_from_fields(kind, p["part"]).alias("b"))
    )
    return F.filter(parsed, lambda p: p["b"]["total_bid_amount"].isNotNull())


def line_bidders(kind: str, text: Column) -> Column:
    """In-row bidders of a bids-as-read or bid-summary text; missing ranks become list positions."""
    return F.transform(
        located_bidders(kind, text),
        lambda p, i: p["b"].withField("bid_rank", F.coalesce(p["b"]["bid_rank"], (i + 1).cast("int"))),
    )


def bidder_rows(pages: DataFrame, kind: str) -> DataFrame:
    """Long form of `line_bidders`: lines never cross pages, so pages(doc_id, page_no, text) are parsed where
    they lie and only accepted lines leave them, with the rank as printed."""
    return pages.select("doc_id", "page_no", F.inline(located_bidders(kind, F.col("text")))).select(
        "doc_id", "page_no", "line_no", "b.*"
    )


def rank_fill(rows: DataFrame) -> DataFrame:
    """Rank = ordinal of the row in its document where the text gives none.

    Counting reads the rows twice: pass a written table (`session.materialise`), or they are parsed from text again.
    """
    located = rows.withColumn(
        "_at", F.shiftleft(F.col("page_no").cast("bigint"), 32) + F.col("line_no").cast("bigint")
    )
    counted = running_count(located, ["doc_id"], "_at", F.lit(True), "_ordinal", block=1 << 38)
    return counted.withColumn("bid_rank", F.coalesce("bid_rank", F.col("_ordinal").cast("int"))).drop("_at", "_ordinal")


# ---- bidders found over the whole text ---------------------------------------------------------------
def item_c_bidders(text: Column) -> Column:
    """Rank is the match ordinal; a match whose numbers do not parse is dropped but keeps its ordinal."""
    found = captures(unmarked(text), ITEM_C_BIDDER, (1, 2, 3, 4))
    parsed = F.transform(
        found,
        lambda m, i: _bidder(strip(m[0]), strip(m[1]), parse_money(m[2]), i + 1, parse_number(m[3])),
    )
    return F.filter(parsed, lambda b: b["total_bid_amount"].isNotNull() & b["percentage_diff"].isNotNull())


_EVENT = "struct<at:int,side:int,ordinal:int,amount:decimal(18,2)>"


def bid_tab_bidders(text: Column) -> Column:
    """Each bidder takes the first readable total that starts after the bidder's own text.

    Bidders and totals are merged by position and folded once from the end, carrying the nearest
    total to the right.
    """
    return let(unmarked(text), _bid_tab_bidders)


def _bid_tab_bidders(clean: Column) -> Column:
    totals = F.filter(
        F.transform(
            located_captures(clean, rx(TOTAL), (1,)),
            lambda m: F.struct(
                m["start"].alias("at"), F.lit(0).alias("side"), F.lit(0).alias("ordinal"), parse_money(m["fields"][0]).alias("amount"),
            ).cast(_EVENT),
        ),
        lambda t: t["amount"].isNotNull(),
    )

    def matched(found: Column) -> Column:
        bidders = F.transform(found, lambda m, i: F.struct(
            m["stop"].alias("at"), F.lit(1).alias("side"), (i + 1).cast("int").alias("ordinal"),
            F.lit(None).cast("decimal(18,2)").alias("amount")).cast(_EVENT))
        # at equal positions the total sorts first, hence is met last from the right: it must start after
        return let(F.sort_array(F.concat(bidders, totals), asc=False), lambda from_right: let(
            running_states(
                from_right, F.lit(None), lambda nearest, event: F.when(event["side"] == 0, event["amount"]).otherwise(nearest), "decimal(18,2)"),
            # one amount for each event, of which the bidders' are kept and put back in order
            lambda nearest: _priced(found, F.reverse(F.filter(nearest, lambda _, i: from_right[i]["side"] == 1)))))

    return with_section_ranks(let(located_captures(clean, BID_TAB_BIDDER, (1, 2)), matched), clean)


def _priced(found: Column, amounts: Column) -> Column:
    return let(amounts, lambda nearest: F.transform(found, lambda m, i: _bidder(
        strip(m["fields"][0]), strip(m["fields"][1]), F.get(nearest, i), i + 1, F.lit(None))))


def section_ranks(text: Column) -> Column:
    """Ranks printed in the "bidders in order" section, one per line, null where a line has none."""
    section = F.regexp_extract(text, rx(RANK_SECTION, "s"), 1)
    return F.transform(
        F.split(strip(section), "\n"), lambda l: parse_int(F.regexp_extract(l, rx(RANK_LINE), 1))
    )


def with_section_ranks(bidders: Column, text: Column) -> Column:
    """The section's n-th line overrides the rank of the n-th bidder, by position and not by name."""
    return let(
        section_ranks(text),
        lambda ranks: F.transform(
            bidders, lambda b, i: b.withField("bid_rank", F.coalesce(F.get(ranks, i), b["bid_rank"]))
        ),
    )


# ---- bid items ---------------------------------------------------------------------------------------
def _unit_words(token: Column, following: Column) -> Column:
    """How many tokens from here on form a unit: two, one or none."""
    pair = F.upper(F.concat_ws(" ", token, following))
    return F.when(pair.isin(*UNITS), F.lit(2)).when(F.upper(token).isin(*UNITS), F.lit(1)).otherwise(F.lit(0))


def _unit_and_description(tokens: Column) -> Column:
    """struct(unit, description): the right-most unit is cut out, what is left describes the item."""
    marks = F.transform(tokens, lambda t, i: F.struct(
        i.alias("at"), _unit_words(t, F.get(tokens, i + 1)).alias("words")))
    last = F.try_element_at(F.filter(marks, lambda m: m["words"] > 0), F.lit(-1))
    return let(last, lambda u: F.struct(
        F.initcap(F.array_join(F.slice(tokens, u["at"] + 1, u["words"]), " ")).alias("unit"),
        F.array_join(
            F.filter(tokens, lambda t, i: u.isNull() | (i < u["at"]) | (i >= u["at"] + u["words"])), " "
        ).alias("description"),
    ))


def item_fields(line: Column) -> Column:
    """Captured texts (number, code, quantity, rest) of an item line, else null."""
    parts = capture_line(line, (rx(ITEM_LINE), (1, 2, 3, 4)))
    return F.when(F.size(parts) > 1, parts)


def item_from_fields(part: Column) -> Column:
    rest = part[3]
    prices = F.filter(
        F.transform(F.regexp_extract_all(rest, F.lit(PRICE), F.lit(0)), parse_money), lambda p: p.isNotNull()
    )
    words = F.filter(
        F.split(strip(rest), rx(r"\s+")), lambda t: ~t.rlike(rx(rf"^{AMOUNT}$"))
    )
    return let(
        F.struct(prices.alias("prices"), let(words, _unit_and_description).alias("text")),
        lambda x: F.struct(
            part[0].alias("item_number"),
            part[1].alias("item_code"),
            blank_to_null(strip(x["text"]["description"])).alias("description"),
            parse_quantity(part[2]).alias("quantity"),
            x["text"]["unit"].alias("unit"),
            F.get(x["prices"], F.lit(0)).alias("unit_price"),
            F.coalesce(F.get(x["prices"], F.lit(1)), F.get(x["prices"], F.lit(0))).alias("total_price"),
            F.lit(None).cast("string").alias("bidder_name"),
        ),
    )


def text_items(text: Column) -> Column:
    """In-row items from text lines."""
    parts = F.filter(
        F.transform(text_lines(text), lambda l: item_fields(strip(l))), lambda p: p.isNotNull()
    )
    return F.transform(parts, item_from_fields)


def item_rows(pages: DataFrame) -> DataFrame:
    """Long form of `text_items` over a page table."""
    return pages.select("doc_id", "page_no", F.posexplode(text_items(F.col("text"))).alias("item_no", "i")).select(
        "doc_id", "page_no", "item_no", "i.*"
    )


def is_item_table(table: Column) -> Column:
    """A header row naming at least three of the item columns, and at least one more row."""
    header = F.lower(F.concat_ws(" ", F.filter(F.get(table, F.lit(0)), lambda c: c != "")))
    hits = sum((F.when(header.contains(w), 1).otherwise(0) for w in TABLE_WORDS), F.lit(0))
    return F.coalesce((F.size(table) >= 2) & (hits >= 3), F.lit(False))


def table_items(tables: Column) -> Column:
    """Items from cell grids, by column position; short rows give nulls, empty rows are skipped."""
    grids = F.filter(tables, is_item_table)
    rows = F.flatten(F.transform(grids, lambda g: F.slice(g, 2, F.greatest(F.size(g), F.lit(1)))))
    filled = F.filter(rows, lambda r: F.exists(r, lambda c: c.isNotNull() & (c != "")))

    def cell(row: Column, at: int) -> Column:
        return F.get(row, F.lit(at))

    return F.transform(filled, lambda r: F.struct(
        cell(r, 0).alias("item_number"),
        F.lit(None).cast("string").alias("item_code"),
        cell(r, 1).alias("description"),
        parse_quantity(cell(r, 2)).alias("quantity"),
        cell(r, 3).alias("unit"),
        parse_money(cell(r, 4)).alias("unit_price"),
        parse_money(cell(r, 5)).alias("total_price"),
        F.lit(None).cast("string").alias("bidder_name"),
    ))


def bid_tab_items(text: Column, tables: Column | None = None) -> Column:
    """Table items; only when there are none, items read from the text."""
    if tables is None:
        return text_items(text)
    found = F.coalesce(table_items(tables), F.expr(f"cast(array() as {S.LIST_TYPES['bid_items']})"))
    return let(found, lambda f: F.when(F.size(f) > 0, f).otherwise(text_items(text)))


def bidders(kind: str, text: Column) -> Column:
    if kind == S.ITEM_C:
        return item_c_bidders(text)
    if kind == S.BID_TABS:
        return bid_tab_bidders(text)
    return line_bidders(kind, text)
