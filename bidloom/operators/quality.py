"""Declared record contracts and table constraints as data-quality reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.text import strip

Checks = list[tuple[str, Column]]


def errors(checks: Checks) -> Column:
    """Names of the checks that hold, in order."""
    return F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in checks)))


def _untyped(name: str, kind: str) -> tuple[str, Column]:
    """A given text that does not read as the wanted type."""
    return f"{name}_type", F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()


def _typed(columns: dict[str, str], present: list[str]) -> Checks:
    return [_untyped(c, t) for c, t in columns.items() if t != "string" and c in present]


def check_contracts(df: DataFrame) -> DataFrame:
    """Key non-empty after trimming, source path given, typed members readable; key is normalised."""
    checks: Checks = [
        ("contract_number_empty", F.coalesce(strip(F.col("contract_number")), F.lit("")) == ""),
        ("source_file_path_missing", F.col("source_file_path").isNull()),
        *_typed(S.CONTRACT_COLUMNS, df.columns),
    ]
    return df.withColumn("errors", errors(checks)).withColumn(
        "contract_number", F.upper(strip(F.col("contract_number")))
    )


def check_bidders(df: DataFrame) -> DataFrame:
    checks: Checks = [
        ("contract_number_missing", F.col("contract_number").isNull()),
        ("bidder_name_empty", F.coalesce(F.length("bidder_name"), F.lit(0)) < 1),
        *_typed({c: t for c, t in S.BIDDER_COLUMNS.items() if c != "is_winner"}, df.columns),
        ("total_bid_amount_negative", F.col("total_bid_amount").try_cast("decimal(38,6)") < 0),
    ]
    return df.withColumn("errors", errors(checks))


def check_items(df: DataFrame) -> DataFrame:
    checks: Checks = [
        ("contract_number_missing", F.col("contract_number").isNull()),
        *_typed(S.ITEM_COLUMNS, df.columns),
    ]
    return df.withColumn("errors", errors(checks))


def check_results(df: DataFrame) -> DataFrame:
    checks: Checks = [
        *((f"{c}_missing", F.col(c).isNull()) for c in ("file_path", "document_type", "extraction_method", "status")),
        ("confidence_score_range", ~F.col("confidence_score").between(0.0, 1.0)),
    ]
    return df.withColumn("errors", errors(checks))


TABLES = {"contracts": S.CONTRACT_COLUMNS, "bidders": S.BIDDER_COLUMNS, "bid_items": S.ITEM_COLUMNS, "extraction_logs": S.LOG_COLUMNS}


def row_checks(table: str, present: list[str]) -> dict[str, Column]:
    """Declared constraints of a table that one row can break, by name, for the columns there are."""
    checks: dict[str, Column] = {f"not_null:{c}": F.col(c).isNull() for c in S.NOT_NULL[table] if c in present}
    checks |= {f"length:{c}": F.length(c) > n for c, n in S.MAX_LENGTH[table].items() if c in present}
    checks |= {
        f"fits:{c}": F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()
        for c, t in TABLES[table].items() if t.startswith("decimal") and c in present
    }
    if table == "extraction_logs":
        checks["domain:status"] = ~F.col("status").isin(*S.LOG_STATUSES)
    return checks


def database_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Violations of every declared constraint of all given tables: (table_name, constraint_name, violations), from one exchange.

    Rows of all tables are reduced to their key, how many of which table they are, and which checks they break, and united; one
    aggregation by `contract_number` adds them up, map-side first, so neither a hot key nor the log's missing key is a large group. Per
    key it shows contracts that share it (`unique`, counted in keys) and children without a contract (`foreign_key`, in rows); a child
    without a key breaks no foreign key."""
    names = list(tables)
    checks = [(t, n, c) for t in names for n, c in row_checks(t, tables[t].columns).items()]
    key = "contract_number"
    parts = []
    for table, df in tables.items():
        keyed = F.col(key).cast("string") if key in df.columns else F.lit(None).cast("string")
        flags = [(F.coalesce(c, F.lit(False)) if t == table else F.lit(False)).cast("bigint").alias(f"c{i}") for i, (t, _, c) in enumerate(checks)]
        parts.append(df.select(keyed.alias(key), *(F.lit(int(t == table)).cast("bigint").alias(f"n_{t}") for t in names), *flags))
    united = reduce(DataFrame.unionByName, parts)
    sums = [F.sum(c).alias(c) for c in united.columns if c != key]
    per_key = united.groupBy(key).agg(*sums)
    report = {(t, n): F.sum(f"c{i}") for i, (t, n, _) in enumerate(checks)}
    named = F.col(key).isNotNull()
    if "contracts" in tables:
        report["contracts", f"unique:{key}"] = F.count_if(named & (F.col("n_contracts") > 1))
        for child in ("bidders", "bid_items"):
            if child in tables:
                report[child, f"foreign_key:{key}"] = F.sum(F.when(named & (F.col("n_contracts") == 0), F.col(f"n_{child}")).otherwise(0))
    whole = per_key.agg(*(F.coalesce(c, F.lit(0)).alias(f"r{i}") for i, c in enumerate(report.values())))
    rows = F.array(*(
        F.struct(F.lit(t).alias("table_name"), F.lit(n).alias("constraint_name"), F.col(f"r{i}").alias("violations"))
        for i, (t, n) in enumerate(report)))
    return whole.select(F.inline(rows))


def constraint_report(df: DataFrame, table: str) -> DataFrame:
    """`database_report` of one table."""
    return database_report({table: df})
