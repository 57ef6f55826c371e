import datetime
import random

import pytest
from pyspark.sql import functions as F

from bidloom import schemas as S
from bidloom.functions import parse as P
from bidloom.functions.text import blank_to_null, rx, squeeze, strip
from bidloom.operators import classify as C
from bidloom.operators import fields as X


def one(spark, col, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(col(F.col("v")).alias("o")).first()["o"]


@pytest.mark.parametrize("name,kind", [
    ("Invitation to Bid.pdf", S.INVITATION), ("Bid Tabs.pdf", S.BID_TABS), ("Award Letter.pdf", S.AWARD),
    ("Item C Report.pdf", S.ITEM_C), ("Bid Summary.pdf", S.SUMMARY), ("Bids As Read.pdf", S.AS_READ), ("Other.pdf", S.UNKNOWN),
    ("a/b/INVITATION to bid tab.PDF", S.INVITATION), ("award/letter/x.pdf", S.UNKNOWN), ("DA1_bid_tab.pdf", S.BID_TABS),
])
def test_filename(spark, name, kind):
    assert one(spark, C.classify_filename, name) == kind


@pytest.mark.parametrize("text,kind", [
    ("Notice to Prospective Bidders", S.INVITATION), ("Notification of Award", S.AWARD), ("Item C $ Totals % Diff", S.ITEM_C),
    ("Roadway Items Bidder", S.BID_TABS), ("Bids as read", S.AS_READ), (None, S.UNKNOWN), ("", S.UNKNOWN), ("bid summary", S.UNKNOWN),
])
def test_content(spark, text, kind):
    assert one(spark, C.classify_content, text) == kind


def test_content_counts_only_when_the_name_is_silent(spark):
    rows = [("x/Bid Tabs.pdf", "bids as read"), ("x/scan.pdf", "bids as read"), ("x/scan.pdf", None)]
    df = C.classify(spark.createDataFrame(rows, "file_path string, first_page string"))
    assert [r.document_type for r in df.collect()] == [S.BID_TABS, S.AS_READ, S.UNKNOWN]


@pytest.mark.parametrize("text,expected", [
    ("January 5, 2024", datetime.date(2024, 1, 5)), ("jan  05 2024", datetime.date(2024, 1, 5)), ("MAY 1 2023", datetime.date(2023, 5, 1)),
    ("02/03/2024", datetime.date(2024, 2, 3)), ("2024-02-29", datetime.date(2024, 2, 29)), ("Feb 30 2024", None), ("Sept 5 2024", None),
    ("Notamonth 5 2024", None), ("", None), (None, None),
])
def test_parse_date(spark, text, expected):
    assert one(spark, P.parse_date, text) == expected


@pytest.mark.parametrize("clock,expected", [
    ("2:00 pm", "2024-01-05 14:00:00"), ("12:30 AM", "2024-01-05 00:30:00"), ("2:00PM", None), ("13:00 PM", None), ("2:61 PM", None),
])
def test_parse_datetime(spark, clock, expected):
    got = one(spark, lambda c: P.parse_datetime(F.lit("January 5, 2024"), c).cast("string"), clock)
    assert got == expected


@pytest.mark.parametrize("text,expected", [("1,387,101.46", "1387101.46"), (",", None), ("", None), ("x", None), (" 5 ", "5.00")])
def test_parse_money(spark, text, expected):
    got = one(spark, P.parse_money, text)
    assert (None if got is None else str(got)) == expected


@pytest.mark.parametrize("text,expected", [
    ("2024-01-05", "2024-01-05 00:00:00"), ("2024-01-05T10:11:12", "2024-01-05 10:11:12"), ("01/05/2024", None), ("2024-13-05", None),
])
def test_iso(spark, text, expected):
    assert one(spark, lambda c: P.parse_iso_timestamp(c).cast("string"), text) == expected


@pytest.mark.parametrize("kind,text,name,expected", [
    (S.INVITATION, "see da00001 and DA00002", "", "DA00001"),
    (S.AWARD, "DA00001 ... Contract No.: da00002", "", "DA00002"),
    (S.ITEM_C, "x DA00001\nDA00002 y", "", "DA00002"),
    (S.ITEM_C, "n 123456789", "", "12345678"),
    (S.BID_TABS, "da00001 then 12345678", "", "12345678"),
    (S.AS_READ, "a_12089199_b", "12089199_Bids As Read.pdf", None),
    (S.AS_READ, "none", "da00543_Bids As Read.pdf", "DA00543"),
    (S.SUMMARY, "no 12089199.", "DA1", "12089199"),
])
def test_contract_number(spark, kind, text, name, expected):
    df = spark.createDataFrame([(text, name)], "t string, n string")
    assert df.select(X.contract_number(kind, F.col("t"), F.col("n")).alias("o")).first()["o"] == expected


def test_first_matching_pattern_wins_even_if_it_yields_nothing(spark):
    text = "The Date of Availability for it is Smarch 13, 2024\nthe Date of Availability is May 1, 2024"
    assert one(spark, lambda c: X.date_available(S.INVITATION, c), text) is None
    assert one(spark, lambda c: X.wbs_element(S.INVITATION, c), "WBS Element: \t \n17BP\nWBS Element 5") == "17BP"


def test_numbers_fall_through_to_the_next_pattern(spark):
    assert one(spark, X.proposal_length, "PROPOSAL LENGTH 1.2.3 MILES and 4.5 MILES") is None
    assert one(spark, X.proposal_length, "PROPOSAL LENGTH . MILES") is None
    assert one(spark, X.proposal_length, "length 4.5 miles") == 4.5
    assert one(spark, X.awarded_amount, "in the amount of $ , only; amount of $ 7.50") is None
    assert str(one(spark, X.awarded_amount, "amount of $ 1,234.5")) == "1234.50"


@pytest.mark.parametrize("text,expected", [
    ("NOTIFICATION OF AWARD\nx\n\ny\n\nFRED SMITH COMPANY\nP.O. Box 1\n", "FRED SMITH COMPANY"),
    ("We are pleased to inform you that  Acme\n Builders PO Box 9 has been awarded", "Acme Builders"),
    ("Award Letter\n\nx\n\n\nlater\n", ""),
    ("nothing", None),
])
def test_awarded_to(spark, text, expected):
    assert one(spark, X.awarded_to, text) == expected


def test_counties_and_description(spark):
    text = "works in Dare,\nHyde & Wake Counties in the state; DA00001 – Grading\n  and   paving\nmore"
    assert one(spark, lambda c: X.counties(S.INVITATION, c), text) == "Dare,\nHyde & Wake"
    assert one(spark, lambda c: X.description(S.INVITATION, c), text) == "Grading and paving"
    assert one(spark, lambda c: X.counties(S.INVITATION, c), "within 5 miles. County: Pitt \n") == "Pitt"
    assert len(one(spark, lambda c: X.description(S.AWARD, c), "Description: " + "x" * 900)) == 500


def test_normalize_key(spark):
    assert one(spark, X.normalize_key, " da123 ") == "DA123"
    assert one(spark, X.normalize_key, "  ") is None


def test_a_text_is_lower_cased_once_for_all_rules(spark):
    docs = spark.createDataFrame([("a/Bid Tab.pdf", "x"), ("a/b.pdf", "ITEM C: % diff"), ("a/b.pdf", None), (None, "BIDS AS READ")],
                                 "file_path string, first_page string")
    typed = C.classify(docs)
    assert [r.document_type for r in typed.collect()] == ["bid_tabs", "item_c_report", "unknown", "bids_as_read"]
    plan = typed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 2  # the file name and the first page


def test_percent_in_a_line_without_one_casts_nothing(spark):
    lines = ["A 1.5%", "A -2 % 3%", "A %", "1 A", "", None, "x1.2.3%"]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, t string").select("i", P.percent_in(F.col("t")).alias("p"))
    assert [r.p for r in sorted(df.collect())] == [1.5, -2.0, None, None, None, None, 2.3]


def test_squeeze_leaves_nothing_that_strip_takes(spark):
    rng = random.Random(9)
    signs = "ab \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0     　"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(9))) for _ in range(2000)]
    df = spark.createDataFrame([(x,) for x in texts], "t string").select(
        squeeze(F.col("t")).alias("a"), strip(F.regexp_replace("t", rx(r"\s+"), " ")).alias("b"))
    assert df.where("NOT (a <=> b)").count() == 0


def test_blank_to_null_calls_no_lambda(spark):
    rows = spark.createDataFrame([("",), (None,), (" ",), ("a",)], "t string")
    made = rows.select(blank_to_null(F.col("t")).alias("t"))
    assert [r.t for r in made.collect()] == [None, None, " ", "a"]
    assert "lambda" not in made._jdf.queryExecution().optimizedPlan().toString()
