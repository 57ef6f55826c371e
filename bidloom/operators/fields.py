"""Scalar fields of each document type as Column expressions over the document text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.parse import parse_date, parse_datetime, parse_money, parse_number
from ..functions.text import blank_to_null, first_match, let, rx, squeeze, strip

# ---- fixed values: field patterns --------------------------------------------------------------------
MONTH_DAY_YEAR = r"[A-Za-z]+\s+\d{1,2},?\s+\d{4}"
SHORT_DATE = r"[A-Z]{3}\s+\d{2}\s+\d{4}"
MONEY = r"[\d,]+\.?\d*"
DA_KEY = r"(DA\d{5})"
DIGIT_KEY = r"(\d{8})"
LONE_DIGIT_KEY = r"\b(\d{8})\b"
# One "in" per stretch of list characters is enough: if a later one in the same stretch reached the
# word County, so would the first. The atomic group keeps long prose linear.
# The group begins at once and ends a blank before the word; it is trimmed afterwards, and no run of blanks can be
# shared out in several ways.
COUNTY_LIST = r"(?<![A-Za-z,\s&])(?>[A-Za-z,\s&]*?in\s)([A-Za-z,\s&]+)\sCount(?:y|ies)"
# Published as (\s+.*?)\s+has been awarded. The blanks before the name stay with it, and where nothing but blanks
# stands before the words the group is blanks. What comes before is fixed at its first occurrence: if no award
# follows there, none follows later.
AWARDED_NAME = r"(\s++.*?(?=\shas been awarded)|\s++(?<=\s\s)(?=has been awarded))"
AWARDED_TO = [
    r"\A(?>.*?(?:NOTIFICATION OF AWARD|Award Letter))(?>.*?\n\n)(?>.*?\n(?=\n))(\n.*?)\n",
    rf"\A(?>.*?pleased to inform you that(?=\s)){AWARDED_NAME}",
    rf"\A(?>.*?Dear\s++Sir/\s*+Madam:)(?>.*?inform you that(?=\s)){AWARDED_NAME}",
]


def _any(text: Column, *patterns: str, flags: str = "i") -> Column:
    return first_match(text, *((rx(p, flags), 1) for p in patterns))


def key_from_name(file_name: Column) -> Column:
    """Contract key hidden in a file name; an eight-digit key glued to `_` does not count."""
    return F.upper(_any(file_name, DA_KEY, LONE_DIGIT_KEY))


def contract_number(kind: str, text: Column, file_name: Column | None = None) -> Column:
    if kind == S.INVITATION:
        return F.upper(_any(text, DA_KEY))
    if kind == S.AWARD:
        return F.upper(_any(text, r"Contract No\.?\s*:?\s*(DA\d{5})", DA_KEY))
    if kind == S.ITEM_C:
        return first_match(text, (rx(r"^(DA\d{5})", "m"), 1), (rx(DA_KEY), 1), (rx(DIGIT_KEY), 1))
    if kind == S.BID_TABS:
        return first_match(text, (rx(DA_KEY), 1), (rx(DIGIT_KEY), 1))
    in_text = F.upper(_any(text, DA_KEY, LONE_DIGIT_KEY))
    return in_text if file_name is None else F.coalesce(in_text, key_from_name(F.upper(file_name)))


def key_by_page(text: Column, page_ends: Column) -> Column:
    """Bid-tab key of the first page that has one, the DA form first; without page borders the text is one page.

    Keys hold no line break, so none lies across two pages, and the first key of each form decides.
    """
    def before(key: str) -> Column:
        return F.length(F.regexp_extract(text, rx(rf"\A(.*?){key}", "s"), 1))

    def chosen(found: Column) -> Column:
        border = F.exists(page_ends, lambda end: (end > found["digits_at"]) & (end <= found["da_at"]))
        digits_first = found["digits"].isNotNull() & (found["da"].isNull() | F.coalesce(border, F.lit(False)))
        return F.when(digits_first, found["digits"]).otherwise(found["da"])

    da, digits = first_match(text, (rx(DA_KEY), 1)), first_match(text, (rx(DIGIT_KEY), 1))
    return let(
        F.struct(da.alias("da"), digits.alias("digits"), before(DA_KEY).alias("da_at"), before(DIGIT_KEY).alias("digits_at")),
        chosen,
    )


def wbs_element(kind: str, text: Column) -> Column:
    if kind == S.AWARD:
        return strip(_any(text, r"WBS\s+Element:\s+([^\n]+)"))
    return strip(_any(text, r"WBS Element:\s*([^\n]+)", r"WBS\s*Element\s*:?\s*([^\n]+)"))


def counties(kind: str, text: Column) -> Column:
    if kind == S.AWARD:
        return strip(_any(text, r"County:\s+([^\n]+)"))
    return strip(_any(text, COUNTY_LIST, r"County:\s*([^\n]+)"))


def description(kind: str, text: Column) -> Column:
    if kind == S.AWARD:
        raw = _any(text, r"Description:\s+([^\n]+(?:\n[^\n]+)?)")
    else:
        raw = _any(text, r"DA\d{5}\s*[–-]\s*([^\n]+(?:\n[^\n]+)?)", r"Description:\s*([^\n]+)")
    return F.substring(squeeze(raw), 1, 500)


def date_available(kind: str, text: Column) -> Column:
    if kind == S.ITEM_C:
        return parse_date(_any(text, rf"DATE AVAILABLE\s+({SHORT_DATE})"))
    return parse_date(_any(text, rf"Date of Availability[^\n]*?is\s+({MONTH_DAY_YEAR})"))


def completion_date(kind: str, text: Column) -> Column:
    if kind == S.ITEM_C:
        return parse_date(_any(text, rf"FINAL COMPLETION\s+({SHORT_DATE})"))
    return parse_date(_any(text, rf"Completion Date[^\n]*?is\s+({MONTH_DAY_YEAR})"))


def goal(name: str, text: Column) -> Column:
    labels = {
        "mbe_goal": ["Minority Business Enterprise Goal", "MBE Goal"],
        "wbe_goal": ["Women Business Enterprise Goal", "WBE Goal"],
        "combined_goal": ["Combined MBE/WBE Goal"],
    }[name]
    return _any(text, *(rf"{label}\s*=\s*(\d+\.?\d*)%?" for label in labels)).try_cast("double")


def bid_opening_date(text: Column) -> Column:
    long_form = rx(
        rf"Bid Opening will be at\s+(\d{{1,2}}:\d{{2}}\s*[ap]m)\s+on\s+([A-Za-z]+day)\s+({MONTH_DAY_YEAR})", "i"
    )
    short_form = rx(rf"(\d{{1,2}}:\d{{2}}\s*[AP]M)\s+({MONTH_DAY_YEAR})", "i")
    date_text = first_match(text, (long_form, 3), (short_form, 2))
    time_text = first_match(text, (long_form, 1), (short_form, 1))
    return parse_datetime(date_text, time_text)


def awarded_to(text: Column) -> Column:
    # each group starts with the whitespace before the name, so that it is never empty
    raw = first_match(text, *((rx(p, "is"), 1) for p in AWARDED_TO))

    def without_box(name: Column) -> Column:
        boxed = name.contains("P.O. Box") | name.contains("PO Box")
        cut = F.substring_index(F.substring_index(name, "P.O.", 1), "PO", 1)
        return strip(F.when(boxed, cut).otherwise(name))

    return let(squeeze(raw), without_box)


def awarded_amount(text: Column) -> Column:
    """A number that does not parse hands over to the next pattern."""
    patterns = [rf"in the amount of\s+\$\s*({MONEY})", rf"amount of\s+\$\s*({MONEY})"]
    return F.coalesce(*(parse_money(_any(text, p)) for p in patterns))


def award_date(text: Column) -> Column:
    return parse_date(
        _any(
            text,
            rf"NOTIFICATION OF AWARD\s+({MONTH_DAY_YEAR})",
            rf"Award Letter\s+({MONTH_DAY_YEAR})",
            rf"^({MONTH_DAY_YEAR})",
            flags="im",
        )
    )


def proposal_length(text: Column) -> Column:
    patterns = [r"PROPOSAL LENGTH\s+([\d.]+)\s+MILES", r"(?<![\d.])([\d.]++)\s+MILES"]
    return F.coalesce(*(parse_number(_any(text, p)) for p in patterns))


def type_of_work(text: Column) -> Column:
    return strip(_any(text, r"TYPE OF WORK\s+([^\n]+)"))


def location(text: Column) -> Column:
    return strip(_any(text, r"LOCATION\s+([^\n]+)"))


def estimated_cost(text: Column) -> Column:
    return parse_money(_any(text, rf"ESTIMATE\s+({MONEY})"))


def scalar_fields(kind: str, text: Column, file_name: Column) -> dict[str, Column]:
    """Every scalar field that this document type yields, by name."""
    makers = {
        "contract_number": lambda: contract_number(kind, text, file_name),
        "wbs_element": lambda: wbs_element(kind, text),
        "counties": lambda: counties(kind, text),
        "description": lambda: description(kind, text),
        "date_available": lambda: date_available(kind, text),
        "completion_date": lambda: completion_date(kind, text),
        "mbe_goal": lambda: goal("mbe_goal", text),
        "wbe_goal": lambda: goal("wbe_goal", text),
        "combined_goal": lambda: goal("combined_goal", text),
        "bid_opening_date": lambda: bid_opening_date(text),
        "proposal_length": lambda: proposal_length(text),
        "type_of_work": lambda: type_of_work(text),
        "location": lambda: location(text),
        "estimated_cost": lambda: estimated_cost(text),
        "awarded_amount": lambda: awarded_amount(text),
        "awarded_to": lambda: awarded_to(text),
        "award_date": lambda: award_date(text),
    }
    return {f: makers[f]() for f in S.EMITTED_FIELDS[kind] if f in makers}


def normalize_key(col: Column) -> Column:
    return blank_to_null(F.upper(strip(col)))
