"""Business rules, status, mapping, record contracts."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from bidloom import schemas as S
from bidloom.operators import mapping as M
from bidloom.operators import quality as Q
from bidloom.operators import report as R
from bidloom.operators import status as ST
from bidloom.operators import validate as V
from bidloom.plans.documents import process_documents

BIDDERS = "array<struct<bidder_name:string,bidder_location:string,total_bid_amount:decimal(18,2),bid_rank:int,percentage_diff:double,is_winner:boolean>>"


def bidder(name, amount, rank=None, winner=None):
    return (name, None, amount, rank, None, winner)


def item(name, total):
    return (None, None, None, None, None, None, total, name)


def results(spark, **fields):
    """One successful result with the given data fields."""
    import decimal

    def fix(v):
        if isinstance(v, list):
            return [tuple(decimal.Decimal(str(x)) if isinstance(x, float) else x for x in row) for row in v]
        return v

    names = list(S.FIELD_TYPES)
    values = tuple(fix(fields.get(n)) for n in names)
    values = tuple(decimal.Decimal(str(v)) if S.FIELD_TYPES[n].startswith("decimal") and v is not None else v for n, v in zip(names, values))
    schema = "file_path string, status string, data struct<" + ",".join(f"{n}:{t}" for n, t in S.FIELD_TYPES.items()) + ">"
    return spark.createDataFrame([("f.pdf", fields.get("status", "success"), values)], schema)


def rule(spark, name, **fields):
    rows = V.rule_table(V.validate_results(results(spark, **fields))).where(F.col("rule") == name).collect()
    return rows[0].valid, rows[0].message


WON = [bidder("Budget Co", 120.0, 2, False), bidder("Acme Builders", 100.0, 2, True)]


@pytest.mark.parametrize("fields,valid,message", [
    (dict(awarded_to="Acme"), True, "No award data to validate"),
    (dict(awarded_amount=0.0, awarded_to="Acme", bidders=WON), True, "No award data to validate"),
    (dict(awarded_amount=100.0, awarded_to="Acme", bidders=WON), True, "Contract totals validated"),
    (dict(awarded_amount=150.0, awarded_to="Acme", bidders=WON), False, "Award amount mismatch: 150.0 != 100.0"),
    (dict(awarded_amount=150.0, awarded_to="Acme"), False, "Winner marked in contract but no winner found in bidders"),
    (dict(awarded_amount=150.0, awarded_to="Acme", bidders=[bidder("A", None, 1)]), True, "Contract totals validated"),
    (dict(awarded_amount=100.02, awarded_to="Acme", bidders=[bidder("A", 100.0, 1), bidder("B", 100.02, 1)]), False,
     "Award amount mismatch: 100.02 != 100.0"),
])
def test_contract_totals(spark, fields, valid, message):
    assert rule(spark, "contract_totals", **fields) == (valid, message)


@pytest.mark.parametrize("items,valid,message", [
    ([item("Acme", 40.0), item("Acme", 60.0)], True, "Bid items validated"),
    ([item("Acme", 40.0), item("Acme", 61.0)], True, "Bid items validated"),
    ([item("Acme", 10.0), item("Acme", 20.0)], False, "Bid items sum mismatch: Acme: total=$100.0, items_sum=$30.0"),
    ([item(None, 100.0)], False, "Bid items sum mismatch: Acme: total=$100.0, items_sum=$0"),
    ([], True, "No data to validate"),
])
def test_bid_items_sum(spark, items, valid, message):
    assert rule(spark, "bid_items_sum", bidders=[bidder("Acme", 100.0), bidder("", 5.0), bidder("Zero", 0.0)], bid_items=items) == (valid, message)


@pytest.mark.parametrize("amounts,valid,message", [
    ([100.0, 105.0, 110.0, 5000.0, 115.0], False, "Outlier bid totals detected: unknown: 5000.0"),
    ([100.0, 105.0, 110.0], True, "Insufficient data for outlier detection"),
    ([5.0, 5.0, 5.0, 5.0], True, "No dispersion for outlier detection"),
    ([1.0, 2.0, 3.0, 4.0], True, "No bidder total outliers"),
])
def test_bidder_outliers(spark, amounts, valid, message):
    bidders = [bidder(None if a == 5000.0 else f"N{i}", a) for i, a in enumerate(amounts)] + [bidder("none", None)]
    assert rule(spark, "bidder_outliers", bidders=bidders) == (valid, message)


D = datetime.date


@pytest.mark.parametrize("fields,message", [
    (dict(date_available=D(2024, 1, 11), completion_date=D(2024, 2, 10)), "Dates validated"),
    (dict(date_available=D(2024, 2, 20), completion_date=D(2024, 2, 10)), "Date available must be before completion date"),
    (dict(bid_opening_date=datetime.datetime(2024, 1, 5, 14), award_date=D(2024, 1, 5)), "Bid opening must be before award date"),
    (dict(bid_opening_date=datetime.datetime(2024, 1, 5), date_available=D(2024, 1, 5)), "Bid opening should be before availability date"),
    (dict(), "Dates validated"),
])
def test_dates(spark, fields, message):
    assert rule(spark, "dates", **fields) == (message == "Dates validated", message)


@pytest.mark.parametrize("combined,valid,message", [
    (5.0, True, "Goals validated"), (4.0, False, "Combined goal (4.0) inconsistent with MBE (2.0) + WBE (3.0)"),
    (4.95, True, "Goals validated"), (9.0, True, "Goals validated"), (None, True, "Goals not all specified"),
])
def test_goals(spark, combined, valid, message):
    assert rule(spark, "goals", mbe_goal=2.0, wbe_goal=3.0, combined_goal=combined) == (valid, message)


def test_only_successful_results_are_judged(spark):
    row = V.validate_results(results(spark, status="partial")).first()
    assert (row.valid, row.message, row.rules) == (True, "Skipped validation for failed extraction", None)


def docs(spark, rows):
    schema = "file_path string, text string, tables array<array<array<string>>>, read_error string, text_length bigint, pages_with_content bigint, page_count bigint"
    full = [(p, t, None, e, len(t or ""), 1 if (t or "").strip() else 0, 1) for p, t, e in rows]
    return spark.createDataFrame(full, schema).withColumn("first_page", F.col("text"))


def processed(spark, rows, **extra):
    df = docs(spark, rows)
    for name, col in extra.items():
        df = df.withColumn(name, col)
    return {r.file_path: r for r in process_documents(df, "run", M.MappingConfig("/nowhere/source")).collect()}


def test_document_plan_states(spark):
    bids = "Bids read aloud on the first Tuesday of the month\n"
    out = processed(spark, [
        ("a/DA00001_Bids As Read.pdf", bids + "RILEY PAVING INC SUPPLY, NC 1,000.00 1", None),
        ("a/12089199_Bids As Read.pdf", bids + "RILEY PAVING INC SUPPLY, NC 1,000.00 1", None),
        ("a/DA00002_Bid Tabs.pdf", "", None),
        ("a/Award Letter.pdf", None, "broken file"),
        ("a/Other.pdf", "nothing to see", None),
    ])
    got = {p.split("/")[1][:8]: (r.status, r.document_type, r.meta.needs_ocr_reasons, r.meta.partial_reasons, r.error) for p, r in out.items()}
    assert got["DA00001_"] == ("success", S.AS_READ, [], [], None)
    assert got["12089199"] == ("partial", S.AS_READ, [], ["missing_contract_number"], None)
    assert got["DA00002_"] == ("partial", S.BID_TABS, ["no_text_extracted", "low_field_coverage"], [], None)
    assert got["Award Le"] == ("failed", S.AWARD, ["no_text_extracted", "empty_data"], [], "broken file")
    assert got["Other.pd"][:2] == ("skipped", S.UNKNOWN) and got["Other.pd"][4] == ST.NO_EXTRACTOR
    tabs = out["a/DA00002_Bid Tabs.pdf"]
    assert tabs.data.contract_number == "DA00002" and tabs.meta.contract_number_source == "filename"
    assert out["a/Other.pdf"].meta.run_id is None and tabs.meta.run_id == "run"
    assert out["a/DA00001_Bids As Read.pdf"].data.bid_items is None, "the mapping drops what the type does not list"


def test_flagged_documents_are_read_again_from_ocr_text(spark):
    text = "NOTIFICATION OF AWARD January 5, 2024\nContract No. DA00077, in the amount of $ 12.50 and no more"
    out = processed(spark, [("x/Award Letter.pdf", "", None), ("x/Award Letter two.pdf", "Contract No. DA00078 " + "." * 50, None)],
                    ocr_text=F.lit(text), ocr_method=F.lit("scan"), ocr_duration_seconds=F.lit(1.5))
    again, kept = out["x/Award Letter.pdf"], out["x/Award Letter two.pdf"]
    assert (again.data.contract_number, float(again.data.awarded_amount), again.status) == ("DA00077", 12.5, "success")
    assert again.meta.ocr_applied and again.meta.ocr_method == "scan" and again.meta.text_length == len(text)
    assert kept.data.contract_number == "DA00078" and not kept.meta.ocr_applied and kept.meta.ocr_method is None


def test_mapping_file_and_fallbacks(tmp_path, monkeypatch):
    folder = tmp_path / "source"
    folder.mkdir()
    assert M.MappingConfig(folder).mappings is M.DEFAULT_MAPPINGS
    target = tmp_path / "file_mappings" / "field_mappings.json"
    target.parent.mkdir()
    target.write_text(json.dumps({S.AWARD: {"mapping_name": "mine", "fields": ["contract_number"]}}))
    config = M.MappingConfig(folder)
    assert config.of(S.AWARD)["mapping_name"] == "mine" and config.source == "external"
    target.write_text("{broken")
    assert M.MappingConfig(folder).mappings is M.DEFAULT_MAPPINGS
    other = tmp_path / "other.json"
    other.write_text(json.dumps({S.AWARD: {"mapping_name": "env"}}))
    monkeypatch.setenv("FILE_MAPPING_PATH", str(other))
    assert M.MappingConfig(folder).of(S.AWARD)["mapping_name"] == "env"


def test_external_mapping_changes_the_document_plan(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text(json.dumps({
        S.AWARD: {"mapping_name": "m", "fields": ["contract_number", "location"], "aliases": {"counties": "location", "wbs_element": "contract_number"}},
        S.AS_READ: {"mapping_name": "n", "fields": ["contract_number", "bidders"], "list_fields": {
            "bidders": {"fields": ["bidder_name", "bidder_location"], "aliases": {"bidder_name": "bidder_location"}}}},
    }))
    rows = [("x/Award Letter.pdf", "Contract No. DA00001\nCounty: Dare\nWBS Element: 17\n" + "." * 40, None),
            ("x/DA00002 Bids As Read.pdf", "RILEY PAVING INC SUPPLY, NC 1,000.00 1\n" + "." * 40, None)]
    done = {r.file_path: r for r in process_documents(docs(spark, rows), "run", M.MappingConfig(".", str(path))).collect()}
    award = done["x/Award Letter.pdf"].data
    assert (award.contract_number, award.location, award.counties) == ("DA00001", "Dare", None)
    first = done["x/DA00002 Bids As Read.pdf"].data.bidders[0]
    assert (first.bidder_name, first.bidder_location, first.total_bid_amount) == ("RILEY PAVING INC", "SUPPLY, NC", None)


def test_alias_never_fills_a_present_null(spark):
    df = spark.createDataFrame([(None, "x")], "target string, other string")
    mapped = M.apply_mapping(df, {"fields": ["target"], "aliases": {"other": "target"}})
    assert mapped.first().target is None
    renamed = M.apply_mapping(df.drop("target"), {"fields": ["target"], "aliases": {"other": "target"}})
    assert renamed.first().target == "x"


def test_triage_facts(spark):
    empty = {"contract_number": F.lit(None).cast("string")}
    one = {"contract_number": F.lit("DA1"), "bidders": F.array(F.lit(1)), "bid_items": F.array().cast("array<int>")}
    row = spark.range(1).select(
        ST.triage_reasons(empty, F.lit(0), F.lit(0)).alias("a"), ST.triage_reasons(one, F.lit(200), F.lit(1)).alias("b")).first()
    assert (row.a, row.b) == (["no_text_extracted", "empty_data"], [])


def test_record_contracts(spark):
    df = spark.createDataFrame([(" da1 ", "p", "x"), ("", None, "2024-01-01")], "contract_number string, source_file_path string, date_available string")
    got = Q.check_contracts(df).collect()
    assert (got[0].contract_number, got[0].errors) == ("DA1", ["date_available_type"])
    assert got[1].errors == ["contract_number_empty", "source_file_path_missing"]
    bad = spark.createDataFrame([("k", "", "-1"), ("k", "x", "0")], "contract_number string, bidder_name string, total_bid_amount string")
    assert [r.errors for r in Q.check_bidders(bad).collect()] == [["bidder_name_empty", "total_bid_amount_negative"], []]


def test_percent_formats_and_empty_runs(spark):
    df = spark.createDataFrame([("t", s) for s in ["success"] * 1 + ["failed"] * 15], "document_type string, status string")
    assert R.run_summary(df).first().success_rate == "6.2%", "ties go to even"
    assert R.run_summary(df.limit(0)).count() == 0
    judged = df.limit(0).withColumn("valid", F.lit(True))
    assert R.validation_summary(judged).first().pass_rate == "N/A"


def test_all_constraints_from_one_exchange(spark):
    contracts = spark.createDataFrame([("A", "w"), ("A", "w"), ("B", "w" * 101), (None, "w"), ("D", None)], "contract_number string, wbs_element string")
    bidders = spark.createDataFrame([("A", "x", 1.0), ("C", None, 99999.0), ("C", "y" * 256, None), (None, "z", None)], "contract_number string, bidder_name string, percentage_diff double")
    items = spark.createDataFrame([("D", "1")] * 3 + [("E", "2")] * 4, "contract_number string, item_number string")
    log = spark.createDataFrame([("f", "success"), (None, "lost"), ("g", None)], "file_path string, status string")
    tables = {"contracts": contracts, "bidders": bidders, "bid_items": items, "extraction_logs": log}
    report = Q.database_report(tables)
    found = {(r.table_name, r.constraint_name): r.violations for r in report.collect()}
    assert {k: v for k, v in found.items() if v} == {
        ("contracts", "not_null:contract_number"): 1, ("contracts", "length:wbs_element"): 1, ("contracts", "unique:contract_number"): 1,
        ("bidders", "not_null:bidder_name"): 1, ("bidders", "length:bidder_name"): 1, ("bidders", "fits:percentage_diff"): 1,
        ("bidders", "foreign_key:contract_number"): 2, ("bid_items", "foreign_key:contract_number"): 4,
        ("extraction_logs", "not_null:file_path"): 1, ("extraction_logs", "domain:status"): 1}
    plan = report._jdf.queryExecution().toString().split("== Physical Plan ==")[1].split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Exchange ") == 2, "one by key, one for the sum of the sums"
    nothing = {n: t.where("1 = 0") for n, t in tables.items()}
    assert {r.violations for r in Q.database_report(nothing).collect()} == {0}
