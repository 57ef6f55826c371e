"""Patterns rewritten for running time: equal to the plain ones on random texts, and linear on long runs of one kind."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from bidloom import schemas as S
from bidloom.functions.text import capture_line, rx, squeeze
from bidloom.operators import fields as X
from bidloom.operators import groups as G

NAME, PLACE, AMOUNT = r"[A-Z][A-Z0-9&.,'\- ]{3,}", r"[A-Z][A-Z .\-]+,\s*[A-Z]{2}", r"[\d,]+\.\d{2}"
PLAIN_LINES = {
    S.AS_READ: [(rf"({NAME})\s+({PLACE})\s+({AMOUNT})(?:\s+(\d+))?", (1, 2, 3, 4, 0))],
    S.SUMMARY: [(rf"(\d+)\s+({NAME})\s+({PLACE})\s+({AMOUNT})(?:\s+([-+]?\d+(?:\.\d+)?))?%?", (2, 3, 4, 1, 5)),
                (rf"({NAME})\s+({PLACE})\s+({AMOUNT})\s+(\d+)", (1, 2, 3, 4, 0))],
}
FIRST = (rf"({AMOUNT})\s+({NAME}+)", (2, 0, 1, 0, 0))
RANK = r"[\d,]+\.?\d*\s*[A-Z\s&]+(?:INC|LLC)?\s+(\d+)"
COUNTIES = r"in\s+([A-Za-z,\s&]+)\s+Count(?:y|ies)"
AWARDED = [r"(?:NOTIFICATION OF AWARD|Award Letter).*?\n\n.*?\n(\n.*?)(?:\n)", r"pleased to inform you that(\s+.*?)\s+has been awarded",
           r"Dear\s+Sir/\s*Madam:.*?inform you that(\s+.*?)\s+has been awarded"]


def texts(seed, n, tokens, most):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(tokens) for _ in range(rnd.randint(1, most))) for _ in range(n)]


def column(spark, values, make):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string").repartition(8)
    return [r.v for r in sorted(df.select("i", make(F.col("t")).alias("v")).collect(), key=lambda r: r.i)]


@pytest.mark.parametrize("kind", [S.AS_READ, S.SUMMARY])
def test_bid_lines(spark, kind):
    words = ["AB", "A", "A.", "-B", ".", "9", "&", "X,", "NC,", ", NC", "NC", "O'X", "1.00", "1,234.50", "5", "AB, NC 1.00", "CD.,NC", "C ,", "7%", "QRS TUV"]
    lines = [" ".join(line.split()) for line in texts(5, 20000, [w + " " for w in words] + ["A", "9,"], 9)]
    if kind == S.SUMMARY:
        lines = [f"3 AB{line}" if i % 2 else line for i, line in enumerate(lines)]
    got = column(spark, lines, lambda t: capture_line(t, *G.LINE_PATTERNS[kind]))
    hits = 0
    for line, found in zip(lines, got):
        want = [line]
        for pattern, groups in [*PLAIN_LINES[kind], FIRST]:
            m = re.fullmatch(pattern, line)
            if m:
                want = [(m[g] or "") if g else "" for g in groups]
                hits += groups[1] > 0
                break
        assert found == want, line
    assert hits > 150


def test_rank_lines(spark):
    lines = texts(6, 8000, ["1", "2,", ".", "A", "INC ", "LLC", " ", "&", "\t", "x", "34"], 12)
    got = column(spark, lines, lambda t: F.regexp_extract(t, rx(G.RANK_LINE), 1))
    want = [m[1] if (m := re.search(RANK, line)) else "" for line in lines]
    assert got == want and sum(map(bool, want)) > 300


def test_counties(spark):
    values = texts(7, 8000, ["in", " in ", "in  ", "A", "x, ", " and ", " ", "\n", " County", "Counties", "  Count", "y", "5", "&"], 12)
    got = column(spark, values, lambda t: X.counties(S.INVITATION, t))
    want = [m[1].strip() if (m := re.search(COUNTIES, v, re.I)) else None for v in values]
    assert got == want and sum(w is not None for w in want) > 300


def test_awarded_to(spark):
    values = texts(8, 8000, ["pleased to inform you that", "inform you that", " ", "  ", " ACME", "\n", "\n\n", "has been awarded", " has been awarded", "Award Letter",
                             "Dear Sir/ Madam:", " x"], 10)
    got = column(spark, values, X.awarded_to)
    want = []
    for v in values:
        m = next((m for p in AWARDED if (m := re.search(p, v, re.I | re.S))), None)
        want.append(" ".join(m[1].split()) if m else None)
    assert got == want and sum(map(bool, want)) > 300


def test_long_runs_stay_linear(spark):
    n = 20000
    runs = ["1" * n, "," * n, " " * n, "A" * n, "1 " * n, "A " * n, "A, " * n, "- " * n, "\n" * n, "1,A " * n]
    heads = ["", "in ", "pleased to inform you that ", "Dear Sir/Madam: inform you that ", "Award Letter", "BIDDERS IN ORDER CONTRACT TOTAL ", "1 ACME "]
    tails = ["", " 9, NC 1.00", "9X, NC 1.00", " x"]
    values = [h + r + t for h in heads for r in runs for t in tails] + ["A " + "B " * n + "9, NC 1.00", "pleased to inform you that " * n, "BIDDERS IN ORDER " * n]
    start = time.time()
    column(spark, values, lambda t: F.concat_ws("|", X.counties(S.INVITATION, t), X.awarded_to(t), F.regexp_extract(t, rx(G.RANK_LINE), 1), *(
        capture_line(squeeze(t), *G.LINE_PATTERNS[k])[0] for k in (S.AS_READ, S.SUMMARY)), F.size(G.section_ranks(t)).cast("string")))
    assert time.time() - start < 60


def test_many_bidders_in_one_text(spark):
    text = "".join(f"ACME {chr(65 + i % 26)} INC DURHAM, NC\nTOTAL {i + 1}.00\n" for i in range(50000))
    start = time.time()
    (found,) = column(spark, [text], G.bid_tab_bidders)
    assert time.time() - start < 30
    assert len(found) == 50000 and float(found[40000].total_bid_amount) == 40001.0 and found[0].bidder_name == "ACME A INC"
