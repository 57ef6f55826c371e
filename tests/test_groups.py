"""Repeating groups against literal cases and against row-wise checks with the plain patterns."""

import random
import re
import time

from pyspark.sql import functions as F

from bidloom import schemas as S
from bidloom.operators import groups as G
from bidloom.operators.asof import next_value

# The plain whole-text patterns; the library uses equivalent forms that stay linear.
ITEM_C = re.compile(r"([A-Z][A-Z\s&]+(?:INC|LLC|CO)?)\s+([A-Z\s,]+)\s+([\d,]+\.?\d*)\s+([-+]?\d+\.?\d*)")
BID_TAB = re.compile(r"([A-Z][A-Z\s&]+(?:INC|LLC|CO)?)\s+([A-Z]+,\s*[A-Z]{2})")
TOTAL = re.compile(r"(?:CONTRACT\s+)?TOTAL\s+([\d,]+\.?\d*)")
PRICE = re.compile(r"[\d,]+\.\d{2}")


def rows(spark, col, text):
    df = spark.createDataFrame([(text,)], "t string").select(F.inline(col(F.col("t"))))
    return [r.asDict() for r in df.collect()]


def number(text):
    try:
        return float(text.replace(",", ""))
    except ValueError:
        return None


def test_as_read_lines(spark):
    text = ("BIDS AS READ\nRILEY PAVING INC SUPPLY, NC 1,387,101.46 1\r\nX CONTRACTING INC WILSON, NC 5.00\n"
            "1,200.50 FOO & BAR, INC. RALEIGH, NC\nlower case, NC 5.00\nACME  CO\tWILSON, NC  7.00\n")
    got = rows(spark, lambda c: G.line_bidders(S.AS_READ, c), text)
    assert [(r["bidder_name"], r["bidder_location"], float(r["total_bid_amount"]), r["bid_rank"]) for r in got] == [
        ("RILEY PAVING INC", "SUPPLY, NC", 1387101.46, 1),
        ("FOO & BAR, INC. RALEIGH, NC", None, 1200.5, 2),
        ("ACME CO", "WILSON, NC", 7.0, 3),
    ]


def test_summary_lines(spark):
    text = "1 RILEY PAVING INC SUPPLY, NC 1,387,101.46 -15.9\n2 FOO INC WILSON, NC 10.00 0.0%\nZED CORP WILSON, NC 11.00 7\n3 A SUMMARY INC X, NC 1.00"
    got = rows(spark, lambda c: G.line_bidders(S.SUMMARY, c), text)
    assert [(r["bidder_name"], r["bid_rank"], r["percentage_diff"]) for r in got] == [
        ("RILEY PAVING INC", 1, -15.9), ("FOO INC", 2, None), ("ZED CORP", 7, None)]


def test_item_c_splits_a_two_word_city_in_the_wrong_place(spark):
    got = rows(spark, G.item_c_bidders, "x STEVENS TOWING CO INC  YONGES ISLAND, SC 2,220,630.54 -15.9\n")
    assert [(r["bidder_name"], r["bidder_location"]) for r in got] == [("STEVENS TOWING CO INC  YONGES", "ISLAND, SC")]


def test_item_c_unreadable_amount_uses_up_its_ordinal(spark):
    got = rows(spark, G.item_c_bidders, "AA BB CC , 5 x DD EE FF 6 7")
    assert [(r["bidder_name"], r["bid_rank"]) for r in got] == [("DD EE", 2)]


def test_bid_tab_bidders_share_a_total_and_take_ranks_by_position(spark):
    text = ("key DA00012\nRILEY PAVING INC SUPPLY, NC\nCONTRACT TOTAL 1,387,101.46\n9 OTHER & SONS LLC DURHAM, NC\nTHIRD CO WILSON, NC\n"
            "TOTAL , \nTOTAL 77\nBIDDERS IN ORDER x CONTRACT TOTAL\n1,387,101.46RILEY PAVING INC 3\nnothing\n\n5 A 9")
    got = rows(spark, G.bid_tab_bidders, text)
    assert [(r["bidder_name"], float(r["total_bid_amount"]), r["bid_rank"]) for r in got] == [
        ("RILEY PAVING INC", 1387101.46, 3), ("OTHER & SONS LLC", 77.0, 2), ("THIRD CO", 77.0, 3)]


TOKENS = ["AB", "A", "INC", "CO", "&", ",", " ", " ", "  ", "\n", "\t", "12", "1,234.50", "5", "-3.5", "+1", ".", "x", "NC", ", SC", "TOTAL",
          "CONTRACT TOTAL", "7,", ",8", "9.9.9", "%"]


TAB_TOKENS = ["AB ", "CD EF ", "INC ", " X, NC", " WILSON, NC", " WILSON,", ",", "\n", "1 ", "TOTAL 5", "CONTRACT TOTAL 1,2.5", "TOTAL , ", "&", " ", "NC", "TO",
              "Q", "x"]


def random_texts(seed, n, parts, tokens=TOKENS):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(tokens) + rnd.choice(["", " ", " "]) for _ in range(rnd.randint(1, parts))) for _ in range(n)]


def test_item_c_equals_the_plain_pattern(spark):
    texts = random_texts(7, 12000, 20)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(8)
    got = {r.i: [(b.bidder_name, b.bidder_location, b.bid_rank, float(b.total_bid_amount), b.percentage_diff) for b in r.b]
           for r in df.select("i", G.item_c_bidders(F.col("t")).alias("b")).collect()}
    hits = 0
    for i, text in enumerate(texts):
        want = []
        for n, m in enumerate(ITEM_C.finditer(text), 1):
            amount, percent = number(m[3]), number(m[4])
            if amount is not None and percent is not None:
                want.append((m[1].strip(), m[2].strip(), n, round(amount, 2), percent))
        hits += bool(want)
        assert got[i] == want, text
    assert hits > 300


def test_bid_tabs_equal_the_plain_patterns(spark):
    texts = random_texts(11, 6000, 18, TAB_TOKENS)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(8)
    got = {r.i: [(b.bidder_name, b.bidder_location, None if b.total_bid_amount is None else float(b.total_bid_amount)) for b in r.b]
           for r in df.select("i", G.bid_tab_bidders(F.col("t")).alias("b")).collect()}
    hits = 0
    for i, text in enumerate(texts):
        totals = [(m.start(), number(m[1])) for m in TOTAL.finditer(text)]
        want = []
        for m in BID_TAB.finditer(text):
            total = next((v for at, v in totals if at > m.end() and v is not None), None)
            want.append((m[1].strip(), m[2].strip(), None if total is None else round(total, 2)))
        hits += bool(want)
        assert got[i] == want, text
    assert hits > 300


def test_long_upper_case_text_stays_fast(spark):
    texts = ["AB CD " * 30000, "ABCDEF, " * 20000 + "& X 5", "AB CD " * 30000 + "& 5 6", "A, " * 30000 + "B C D 5 6", "FOO BAR &BAZ " * 9000 + ", X 1 x",
             "ABCDEFGH" * 20000, "AB 5 " * 30000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    start = time.time()
    df.select(F.size(G.item_c_bidders(F.col("t"))), F.size(G.bid_tab_bidders(F.col("t"))),
              F.size(G.line_bidders(S.AS_READ, F.col("t"))), F.size(G.line_bidders(S.SUMMARY, F.col("t")))).collect()
    assert time.time() - start < 60


def test_items_from_text(spark):
    text = ("0001 P12 1,200.5 Grading work LUMP SUM here 12.345 100.00 200.00\n  0002 P13 5 EA 9.00\n0003 P14 5 just text\nx 0004\n"
            "0005 P1 2 sum lump sum Lump EA sum 3.00")
    got = rows(spark, G.text_items, text)
    keys = ("item_number", "item_code", "description", "quantity", "unit", "unit_price", "total_price")
    plain = [tuple(float(r[k]) if k in keys[3:4] + keys[5:] and r[k] is not None else r[k] for k in keys) for r in got]
    assert plain == [
        ("0001", "P12", "Grading work here 12.345", 1200.5, "Lump Sum", 12.34, 100.0),
        ("0002", "P13", None, 5.0, "Ea", 9.0, 9.0),
        ("0003", "P14", "just text", 5.0, None, None, None),
        ("0005", "P1", "sum lump sum Lump sum", 2.0, "Ea", 3.0, 3.0),
    ]


def test_prices_equal_the_plain_pattern(spark):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("12,.5 x") for _ in range(rnd.randint(1, 18))) for _ in range(1500)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.p for r in df.select("i", F.regexp_extract_all("t", F.lit(G.PRICE), F.lit(0)).alias("p")).collect()}
    for i, text in enumerate(texts):
        assert got[i] == PRICE.findall(text), text


def test_item_tables(spark):
    header = ["Item", "Description", "Quantity", "Unit", None, "Total"]
    tables = [[header, ["1", "Grading", "1,000", "EA", "2.50", "2,500.00"], [], [None, ""], ["2", "Short"]], [["Name", "Total"], ["a", "b"]], [header]]
    df = spark.createDataFrame([(tables, "0009 P1 1 EA 1.00"), ([], "0009 P1 1 EA 1.00"), (None, "none")], "t array<array<array<string>>>, x string")
    got = df.select(G.bid_tab_items(F.col("x"), F.col("t")).alias("i")).collect()
    assert [(i.item_number, i.description, i.unit) for i in got[0].i] == [("1", "Grading", "EA"), ("2", "Short", None)]
    assert str(got[0].i[0].quantity) == "1000.000" and got[0].i[1].total_price is None
    assert [i.item_number for i in got[1].i] == ["0009"] and got[2].i == []


def test_page_form_gives_the_same_rows_and_ranks_as_the_document_form(spark):
    lines = [f"ACME {'ABCDEFGH'[i % 8]}X INC WILSON, NC {i + 1},000.00{' 9' if i % 5 == 0 else ''}" for i in range(40)]
    pages = [("d", p, "head\n" + "\n".join(lines[p * 10:(p + 1) * 10])) for p in range(4)] + [("e", 0, lines[0])]
    df = spark.createDataFrame(pages, "doc_id string, page_no int, text string").repartition(5)
    long = G.rank_fill(G.bidder_rows(df, S.AS_READ)).where("doc_id = 'd'").orderBy("page_no", "line_no").collect()
    whole = rows(spark, lambda c: G.line_bidders(S.AS_READ, c), "\n".join(lines))
    assert [(r.bidder_name, r.total_bid_amount, r.bid_rank) for r in long] == [
        (r["bidder_name"], r["total_bid_amount"], r["bid_rank"]) for r in whole]


def test_next_value_over_blocks_equals_brute_force(spark):
    rnd = random.Random(5)
    left = [("hot" if i % 3 else "k%d" % (i % 7), rnd.randint(0, 300), i) for i in range(400)]
    right = [("hot" if i % 3 else "k%d" % (i % 7), rnd.randint(0, 300), None if i % 4 == 0 else i) for i in range(200)]
    right = list({(k, p): (k, p, v) for k, p, v in right}.values())
    got = next_value(spark.createDataFrame(left, "k string, p int, id int"), spark.createDataFrame(right, "k string, p int, v int"),
                     ["k"], "p", "v", "nxt", block=16)
    have = {r.id: r.nxt for r in got.collect()}
    assert len(have) == len(left)
    for k, p, i in left:
        later = sorted((q, v) for kk, q, v in right if kk == k and q > p and v is not None)
        assert have[i] == (later[0][1] if later else None)


# The plain line patterns, in order of trial, with the groups (name, place, amount, rank, percent).
NAME, PLACE, AMOUNT = r"[A-Z][A-Z0-9&.,'\- ]{3,}", r"[A-Z][A-Z .\-]+,\s*[A-Z]{2}", r"[\d,]+\.\d{2}"
PLAIN_LINES = {
    S.AS_READ: [(rf"^({NAME})\s+({PLACE})\s+({AMOUNT})(?:\s+(\d+))?$", (1, 2, 3, 4, 0)), (rf"^({AMOUNT})\s+({NAME})(?:\s+({PLACE}))?$", (2, 3, 1, 0, 0))],
    S.SUMMARY: [(rf"^(\d+)\s+({NAME})\s+({PLACE})\s+({AMOUNT})(?:\s+([-+]?\d+(?:\.\d+)?))?%?$", (2, 3, 4, 1, 5)),
                (rf"^({NAME})\s+({PLACE})\s+({AMOUNT})\s+(\d+)$", (1, 2, 3, 4, 0)), (rf"^({AMOUNT})\s+({NAME})(?:\s+({PLACE}))?$", (2, 3, 1, 0, 0))],
}
LINE_TOKENS = ["ACME", "A&B", "CO.", "O'NEIL", " ", " ", "  ", "\t", "WILSON, NC", "NEW BERN, NC", ",", "1,234.50", "5.00", ".50", "7", "-3.5", "0.0%", "%", "x", "(",
               "TOTAL", "SUMMARY", "\n", "\r\n", "3 ", "A, NC", "ST. X-Y, VA"]


def test_bidder_lines_equal_the_plain_patterns(spark):
    texts = random_texts(21, 20000, 9, LINE_TOKENS)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(8)
    for kind in (S.AS_READ, S.SUMMARY):
        got = {r.i: [tuple(b) for b in r.b] for r in df.select("i", G.line_bidders(kind, F.col("t")).alias("b")).collect()}
        hits = 0
        for i, text in enumerate(texts):
            want = []
            for line in (re.sub(r"\s+", " ", x).strip() for x in text.splitlines()):
                if not line or any(w in line for w in G.HEADER_WORDS[kind]):
                    continue
                for pattern, groups in PLAIN_LINES[kind]:
                    m = re.match(pattern, line)
                    if m:
                        name, place, amount, rank, percent = (m[g] if g else None for g in groups)
                        share = float(percent) if percent and float(percent) else None
                        want.append([name.strip(), place, round(number(amount), 2), int(rank) if rank else None, share])
                        break
            for n, row in enumerate(want, 1):
                row[3] = row[3] if row[3] is not None else n
            hits += bool(want)
            assert [[b[0], b[1], float(b[2]), b[3], b[4]] for b in got[i]] == want, text
        assert hits > 100, kind


def test_item_lines_equal_a_row_wise_reading(spark):
    tokens = ["0001 ", "0002 P1 ", "P2 5 ", "1,200.5 ", "Lump ", "SUM ", "lump sum ", "EA ", "ton ", "LS ", "Work ", "12.345 ", "9.00 ", "1,000.00 ", "\n", "x", " ", "5,.00 "]
    rnd = random.Random(9)
    texts = ["0001 P1 2 " + "".join(rnd.choice(tokens) for _ in range(rnd.randint(1, 12))) for _ in range(3000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(8)
    got = {r.i: [(b.item_number, b.item_code, b.description, b.unit, None if b.unit_price is None else float(b.unit_price),
                  None if b.total_price is None else float(b.total_price)) for b in r.b] for r in df.select("i", G.text_items(F.col("t")).alias("b")).collect()}
    for i, text in enumerate(texts):
        want = []
        for line in filter(None, map(str.strip, text.splitlines())):
            m = re.match(r"^(\d{4})\s+(\S+)\s+([\d,]+(?:\.\d+)?)\s+(.+)$", line)
            if m:
                prices = [p for p in map(number, PRICE.findall(m[4])) if p is not None]
                words = [w for w in m[4].split() if not re.fullmatch(r"[\d,]+\.\d{2}", w)]
                spans = [(at, n) for at in range(len(words)) for n in (2, 1) if " ".join(words[at:at + n]).upper() in G.UNITS]
                unit = None
                if spans:
                    at = max(spans)[0]
                    width = next(n for a, n in spans if a == at)
                    unit = " ".join(words[at:at + width]).title()
                    words = words[:at] + words[at + width:]
                want.append((m[1], m[2], " ".join(words) or None, unit, prices[0] if prices else None,
                             prices[1] if len(prices) > 1 else prices[0] if prices else None))
        assert got[i] == want, text


def test_locations_are_those_of_python_over_several_chunks(spark):
    from bidloom.functions import text as X

    texts = ["x" * 7, "", "a1b22", *("".join(f"{'é' * (n % 3)}k{n} " for n in range(size)) for size in (127, 128, 129, 700)), None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select(
        "i", X.located_captures(F.col("t"), r"([a-z])(\d+)", (1, 2)).alias("found")).collect()
    for i, found in rows:
        want = texts[i] and [(m.start(), m.end(), list(m.groups())) for m in re.finditer(r"([a-z])(\d+)", texts[i])]
        assert (found and [(f.start, f.stop, f.fields) for f in found]) == (want or ([] if texts[i] == "" else want)), i
    sums = spark.range(1).select(X.running_states(F.sequence(F.lit(1), F.lit(1000)), F.lit(0), lambda a, n: a + n, "bigint").alias("s")).first().s
    assert sums == [n * (n + 1) // 2 for n in range(1, 1001)]


def test_runs_of_whitespace_and_markers(spark):
    from bidloom.functions import text as X

    texts = ["a b", " a  b ", "a\tb", "a \t b\n", "a\u00a0b", "a \u00a0c", "\u0001a\u0002", "plain", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", X.squeeze("t").alias("s"), X.unmarked(F.col("t")).alias("u"))
    for i, squeezed, clean in rows.collect():
        t = texts[i]
        assert squeezed == (t and re.sub(r"\s+", " ", t).strip()), i
        assert clean == (t and t.replace("\u0001", "\u0003").replace("\u0002", "\u0003")), i


def test_an_as_of_match_is_dealt_by_its_rows(spark, monkeypatch, capsys):
    from bidloom.operators import asof

    monkeypatch.setattr(asof, "TASK_ROWS", 50)
    left = spark.range(400).selectExpr("id % 40 k", "id div 40 at", "id")
    right = spark.range(400).selectExpr("id % 40 k", "id div 40 at", "if(id % 3 = 0, id, null) v")
    got = asof.next_value(left, right, ["k"], "at", "v", "next")
    got.explain()
    assert re.search(r"hashpartitioning\([^)]*, 16\), REPARTITION_BY_NUM", capsys.readouterr().out)
    for r in got.collect():
        assert r.next == next((i for i in range(r.id + 40, 400, 40) if i % 3 == 0), None)
