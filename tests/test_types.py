"""A seventh document type without an edit in the library, rules as a table, files that are refused, the second reader's text."""

import random
import time

import pytest
from pyspark.sql import functions as F

from bidloom import schemas as S
from bidloom.functions.parse import parse_money
from bidloom.operators import classify as C
from bidloom.operators import groups as G
from bidloom.operators import load as L
from bidloom.operators import types as D
from bidloom.operators.mapping import MappingConfig
from bidloom.plans import run
from bidloom.session import materialise
from tests.test_load_and_files import empty_tables
from tests.test_run import FILES, PAGES, T

CONFIG = MappingConfig("/nowhere/source")


def change_order():
    def scalars(text, file_name):
        part = lambda pattern: F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
        return {"contract_number": part(r"Change order for (DA\d{5})"), "order_amount": parse_money(part(r"AMOUNT ([0-9,.]+)")),
                "reason": part(r"REASON ([^\n]+)")}

    return D.DocumentType(
        "change_order", "ChangeOrders", scalars, ["contract_number", "order_amount", "reason"], filename=[["change order"]],
        content=[["change order"], ["amount"]], bidders=lambda text: G.bidders(S.AS_READ, text),
        new_fields={"order_amount": "decimal(18,2)", "reason": "string"}, new_columns={"order_amount": "decimal(15,2)"})


def results(spark, rows, errors=None, alt=None):
    names = sorted({r[0] for r in rows} | set(errors or {}))
    files = spark.createDataFrame([(n, "h", 1, T, (errors or {}).get(n)) for n in names], FILES + ", read_error string")
    alt = None if alt is None else spark.createDataFrame(alt, PAGES)
    return materialise(run.extract_batch(files, spark.createDataFrame(rows, PAGES), "r", None, None, CONFIG, alt), "typed")


def test_a_seventh_type(spark):
    text = "Change order for DA00042\nAMOUNT 1,250.50\nREASON Unsuitable soil\n" + "." * 40
    bids = "Bids read aloud\nACME PAVING INC DURHAM, NC 1,000.00\n" + "." * 40
    rows = [("in/DA00042 Change Order 1.pdf", 0, text), ("in/scan 17.pdf", 0, text), ("in/DA00001_Bids As Read.pdf", 0, bids)]
    before = {r.file_path: r.document_type for r in results(spark, rows).collect()}
    assert before["in/scan 17.pdf"] == S.UNKNOWN
    with D.registered(change_order()):
        done = results(spark, rows)
        got = {r.file_path: r for r in done.collect()}
        for name in ("in/DA00042 Change Order 1.pdf", "in/scan 17.pdf"):
            r = got[name]
            assert (r.document_type, r.status, r.extraction_method) == ("change_order", "success", "ChangeOrders")
            assert (r.data.contract_number, float(r.data.order_amount), r.data.reason, r.data.awarded_to) == ("DA00042", 1250.5, "Unsuitable soil", None)
            assert r.meta.mapping.mapping_name == "change_order_default" and r.meta.mapping.expected_fields == ["contract_number", "order_amount", "reason"]
        assert got["in/DA00001_Bids As Read.pdf"].data.order_amount is None and len(got["in/DA00001_Bids As Read.pdf"].data.bidders) == 1
        contracts = {r.contract_number: r for r in L.contract_rows(done).collect()}
        assert float(contracts["DA00042"].order_amount) == 1250.5
        log = {r.file_path: float(r.confidence_score) for r in L.load_tables(done, empty_tables(spark))["extraction_logs"].collect()}
        assert log["in/scan 17.pdf"] == 1.0
        with pytest.raises(ValueError, match="already"):
            D.register(change_order())
    assert "change_order" not in D.TYPES and "reason" not in S.FIELD_TYPES and "order_amount" not in S.CONTRACT_COLUMNS
    assert all(label != "change_order" for label, _ in C.FILENAME_RULES + C.CONTENT_RULES)
    with pytest.raises(ValueError, match="not declared"):
        D.register(D.DocumentType("x", "X", lambda t, f: {}, ["no_such_field"], filename=[["x"]]))
    with pytest.raises(ValueError, match="no rule"):
        D.register(D.DocumentType("x", "X", lambda t, f: {}, ["contract_number"]))


def test_refused_files_fail_and_blank_texts_take_the_second_readers(spark):
    bids = "Bids read aloud\nACME PAVING INC DURHAM, NC 1,000.00\n" + "." * 40
    rows = [("DA00001_Bids As Read.pdf", 0, " \n"), ("DA00002_Bids As Read.pdf", 0, bids), ("DA00003 Award Letter.pdf", 0, "")]
    alt = [(n, 0, bids.replace("1,000", "2,000")) for n in ("DA00001_Bids As Read.pdf", "DA00002_Bids As Read.pdf", "DA00003 Award Letter.pdf")]
    got = {r.file_path[:7]: r for r in results(spark, rows, {"DA00009_Bid Tabs.pdf": "file of 9 bytes; at most 1 are read"}, alt).collect()}
    assert (got["DA00009"].status, got["DA00009"].error) == ("failed", "file of 9 bytes; at most 1 are read")
    amounts = {n: [float(b.total_bid_amount) for b in got[n].data.bidders] for n in ("DA00001", "DA00002")}
    assert amounts == {"DA00001": [2000.0], "DA00002": [1000.0]}
    assert got["DA00003"].data.awarded_to is None and got["DA00003"].status == "partial", "award letters have one reader"


def test_thousands_of_rules_from_a_table_equal_the_chain(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcde ") for _ in range(rng.randrange(1, 5)))
    rules = [(f"l{n % 50}", [[word() for _ in range(rng.randrange(1, 3))] for _ in range(rng.randrange(1, 4))]) for n in range(120)]
    texts = ["".join(rng.choice("abcdefABC  ") for _ in range(rng.randrange(0, 60))) for _ in range(300)] + [None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(3)
    for some in (rules, rules[60:75], [("any", [[""], ["a"]])]):
        plain = {r.i: r.label for r in df.select("i", C.rule_classify(F.col("t"), some).alias("label")).collect()}
        table = {r.i: r.label for r in C.classify_by_table(df, "t", C.rule_rows(spark, some)).collect()}
        assert table == plain
    many = [(f"l{n}", [[f"w{n} x"], [f"v{n % 7}"]]) for n in range(5000)]
    lines = spark.createDataFrame([(i, f"W{i} X V{i % 7} w{(i * 31) % 5000} x") for i in range(0, 5000, 7)], "i int, t string")
    index = C.RuleIndex([tuple(r) for r in C.rule_rows(spark, many).collect()], "none")
    def chain(text):
        return next((label for label, groups in many if all(any(w in text.lower() for w in g) for g in groups)), "none")
    got = {r.i: r.label for r in C.classify_by_table(lines, "t", C.rule_rows(spark, many), default="none").collect()}
    assert got == {r.i: chain(r.t) for r in lines.collect()}
    assert index.label(None) == "none"
    empty = spark.createDataFrame([], C.RULE_TABLE)
    assert {r.label for r in C.classify_by_table(df, "t", empty).collect()} == {"unknown"}


def test_rules_that_ask_for_the_same_words_are_kept_once(spark, monkeypatch):
    """More rules than words may be sent to tasks, but few different ones: the first of them wins and the table is not refused."""
    monkeypatch.setattr(C, "MOST_WORDS", 50)
    rules = spark.range(3000).selectExpr(
        "cast(2999 - id as int) rule_order", "concat('r', 2999 - id) label", "explode(array(0, 1)) word_group", "id % 5 n").selectExpr(
        "rule_order", "label", "word_group", "if(word_group = 0, cast(n as string), 'the') word")
    df = spark.createDataFrame([(0, "the 3"), (1, "3 an"), (2, "THE 4 and 1"), (3, None)], "i int, t string")
    got = {r.i: r.label for r in C.classify_by_table(df, "t", rules).collect()}
    assert got == {0: "r1", 1: "unknown", 2: "r0", 3: "unknown"}
    two = rules.unionByName(rules.limit(1).selectExpr("rule_order", "'other' label", "word_group", "word"))
    with pytest.raises(ValueError, match="two labels"):
        C.classify_by_table(df, "t", two)


def test_a_word_that_many_rules_share_costs_a_text_nothing():
    rows = [(n, f"r{n}", g, w) for n in range(20000) for g, w in enumerate((f"w{n}", "the"))]
    index = C.RuleIndex(rows, "none")
    index.words = lambda text: set(text.split())
    started = time.perf_counter()
    assert [index.label(f"the w{n} w{n + 1}") for n in range(2000)] == [f"r{n}" for n in range(2000)]
    assert index.label("w7") == "none"
    assert time.perf_counter() - started < 1
