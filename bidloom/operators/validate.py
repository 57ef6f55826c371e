"""Business rules.

`*_rule` functions judge one result row (its lists are bounded by the document that holds them) and
need no shuffle. The table functions judge contracts, bidders and items that lie in separate tables;
they aggregate before they join, so one hot contract does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parse import falsy, money_text
from ..functions.ranks import quantiles_of, value_ranks
from ..functions.text import computed_once, let, running_fold

# Tolerances and messages
AWARD_TOLERANCE = 0.01
ITEM_TOLERANCE = 1.0
GOAL_TOLERANCE = 0.1
FENCE = 1.5
MIN_BIDS = 4
RULES = ["contract_totals", "bid_items_sum", "dates", "goals", "bidder_outliers"]
NO_AWARD = "No award data to validate"
NO_WINNER = "Winner marked in contract but no winner found in bidders"
TOTALS_OK = "Contract totals validated"
NO_ITEMS = "No data to validate"
ITEMS_OK = "Bid items validated"
FEW_BIDS = "Insufficient data for outlier detection"
NO_SPREAD = "No dispersion for outlier detection"
NO_OUTLIERS = "No bidder total outliers"
AVAILABLE_LATE = "Date available must be before completion date"
OPENING_AFTER_AWARD = "Bid opening must be before award date"
OPENING_LATE = "Bid opening should be before availability date"
DATES_OK = "Dates validated"
GOALS_OPEN = "Goals not all specified"
GOALS_OK = "Goals validated"
SKIPPED = "Skipped validation for failed extraction"


def _verdict(valid: Column | bool, message: Column | str) -> Column:
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(as_col(valid).alias("valid"), as_col(message).alias("message"))


def _far(a: Column, b: Column, tolerance: float) -> Column:
    return F.abs(a.cast("double") - b.cast("double")) > tolerance


def _is_first(bidder: Column) -> Column:
    return F.coalesce(bidder["is_winner"], F.lit(False)) | F.coalesce(bidder["bid_rank"] == 1, F.lit(False))


# ---- rules on one row -----------------------------------------------------------------------------
def totals_rule(amount: Column, awarded_to: Column, winner_found: Column, winner_amount: Column) -> Column:
    mismatch = ~falsy(winner_amount) & _far(amount, winner_amount, AWARD_TOLERANCE)
    text = F.concat(
        F.lit("Award amount mismatch: "), money_text(amount), F.lit(" != "), money_text(winner_amount)
    )
    return (
        F.when(falsy(amount) | falsy(awarded_to, "text"), _verdict(True, NO_AWARD))
        .when(~winner_found, _verdict(False, NO_WINNER))
        .when(mismatch, _verdict(False, text))
        .otherwise(_verdict(True, TOTALS_OK))
    )


def dates_rule(available: Column, completion: Column, opening: Column, award: Column) -> Column:
    a, c, o, w = (x.cast("timestamp_ntz") for x in (available, completion, opening, award))
    return (
        F.when(a >= c, _verdict(False, AVAILABLE_LATE))
        .when(o > w, _verdict(False, OPENING_AFTER_AWARD))
        .when(o >= a, _verdict(False, OPENING_LATE))
        .otherwise(_verdict(True, DATES_OK))
    )


def goals_rule(mbe: Column, wbe: Column, combined: Column) -> Column:
    m, w, c = (x.cast("double") for x in (mbe, wbe, combined))
    text = F.format_string("Combined goal (%s) inconsistent with MBE (%s) + WBE (%s)",
                           *(x.cast("string") for x in (c, m, w)))
    return (
        F.when(m.isNull() | w.isNull() | c.isNull(), _verdict(True, GOALS_OPEN))
        .when((F.abs(c - (m + w)) > GOAL_TOLERANCE) & (c < m + w), _verdict(False, text))
        .otherwise(_verdict(True, GOALS_OK))
    )


def _item_sums(bidders: Column, items: Column) -> Column:
    """For every bidder, in order: (at, n, sum) of its items, in n log n.

    Items that name their bidder and have a price are sorted by name together with the bidders, each bidder behind its items, and one
    fold over them carries the count and sum of the current name."""
    price = "decimal(28,2)"
    event = lambda name, side, at, amount: F.struct(
        name.alias("name"), F.lit(side).alias("side"), at.cast("int").alias("at"), amount.cast(price).alias("price"))
    named = F.filter(items, lambda i: i["bidder_name"].isNotNull() & ~falsy(i["total_price"]))
    sold = F.transform(named, lambda i: event(i["bidder_name"], 0, F.lit(0), i["total_price"]))
    asked = F.transform(bidders, lambda b, at: event(b["bidder_name"], 1, at, F.lit(0)))

    def step(run: Column, e: Column) -> tuple[Column, Column]:
        same, item = F.coalesce(run["name"] == e["name"], F.lit(False)), e["side"] == 0
        n = F.when(same, run["n"]).otherwise(0) + F.when(item, 1).otherwise(0)
        total = (F.when(same, run["sum"]).otherwise(F.lit(0).cast(price)) + e["price"]).cast(price)
        state = F.struct(e["name"].alias("name"), n.cast("int").alias("n"), total.alias("sum"))
        return state, F.when(~item, F.struct(e["at"].alias("at"), n.cast("int").alias("n"), total.alias("sum")))

    start = F.struct(F.lit(None).cast("string").alias("name"), F.lit(0).alias("n"), F.lit(0).cast(price).alias("sum"))
    return F.array_sort(running_fold(F.array_sort(F.concat(sold, asked)), start, step, f"struct<at:int,n:int,sum:{price}>"))


def items_rule(bidders: Column, items: Column) -> Column:
    """Only items that name their bidder and have a price can count for a bidder."""
    def mismatch(bidder: Column, own: Column) -> Column:
        return F.when(
            ~falsy(bidder["bidder_name"], "text") & ~falsy(bidder["total_bid_amount"])
            & _far(bidder["total_bid_amount"], own["sum"], ITEM_TOLERANCE),
            F.concat(bidder["bidder_name"], F.lit(": total=$"), money_text(bidder["total_bid_amount"]),
                     F.lit(", items_sum=$"), F.when(own["n"] == 0, "0").otherwise(money_text(own["sum"]))),
        )

    def judged(found: Column) -> Column:
        return F.when(F.size(found) > 0, _verdict(
            False, F.concat(F.lit("Bid items sum mismatch: "), F.array_join(found, "; "))
        )).otherwise(_verdict(True, ITEMS_OK))

    texts = F.array_compact(F.zip_with(bidders, _item_sums(bidders, items), mismatch))
    return F.when(falsy(bidders, "list") | falsy(items, "list"), _verdict(True, NO_ITEMS)).otherwise(let(texts, judged))


def outliers_rule(bidders: Column) -> Column:
    def quartile(sorted_amounts: Column, p: float) -> Column:
        place = (F.size(sorted_amounts) - 1) * F.lit(p)
        low = F.floor(place).cast("int")
        weight = place - low
        upper = F.least(low + 1, F.size(sorted_amounts) - 1)
        return F.get(sorted_amounts, low) * (1 - weight) + F.get(sorted_amounts, upper) * weight

    def judged(fence: Column) -> Column:
        spread = fence["q3"] - fence["q1"]
        outside = F.filter(bidders, lambda b: b["total_bid_amount"].isNotNull() & (
            (b["total_bid_amount"].cast("double") < fence["q1"] - FENCE * spread)
            | (b["total_bid_amount"].cast("double") > fence["q3"] + FENCE * spread)))
        texts = F.transform(outside, lambda b: F.concat(
            F.when(falsy(b["bidder_name"], "text"), "unknown").otherwise(b["bidder_name"]),
            F.lit(": "), money_text(b["total_bid_amount"])))
        return F.when(spread == 0, _verdict(True, NO_SPREAD)).otherwise(let(texts, lambda t: F.when(
            F.size(t) > 0,
            _verdict(False, F.concat(F.lit("Outlier bid totals detected: "), F.array_join(t, ", "))),
        ).otherwise(_verdict(True, NO_OUTLIERS))))

    amounts = F.array_sort(F.filter(
        F.transform(bidders, lambda b: b["total_bid_amount"].cast("double")), lambda a: a.isNotNull()))
    return let(F.coalesce(amounts, F.array().cast("array<double>")), lambda a: F.when(
        F.size(a) < MIN_BIDS, _verdict(True, FEW_BIDS)
    ).otherwise(let(F.struct(quartile(a, 0.25).alias("q1"), quartile(a, 0.75).alias("q3")), judged)))


def validate_results(results: DataFrame) -> DataFrame:
    """Add `rules` array<struct(rule, valid, message)>, `valid` and `message` to every result row."""
    data = F.col("data")
    bidders, items = data["bidders"], data["bid_items"]

    def totals(winners: Column) -> Column:
        return totals_rule(data["awarded_amount"], data["awarded_to"], F.size(winners) > 0,
                           F.get(winners, F.lit(0))["total_bid_amount"])

    verdicts = {
        "contract_totals": let(F.coalesce(F.filter(bidders, _is_first), F.array()), totals),
        "bid_items_sum": items_rule(bidders, items),
        "dates": dates_rule(data["date_available"], data["completion_date"], data["bid_opening_date"], data["award_date"]),
        "goals": goals_rule(data["mbe_goal"], data["wbe_goal"], data["combined_goal"]),
        "bidder_outliers": outliers_rule(bidders),
    }
    def named(rule: str) -> Column:
        return let(verdicts[rule], lambda v: F.struct(
            F.lit(rule).alias("rule"), v["valid"].alias("valid"), v["message"].alias("message")))

    rows = F.array(*(named(r) for r in RULES))
    judged = computed_once(results, rules=F.when(F.col("status") == "success", rows))
    return judged.withColumn("valid", F.coalesce(F.forall("rules", lambda r: r["valid"]), F.lit(True))).withColumn(
        "message", F.when(F.col("rules").isNull(), SKIPPED)
    )


def rule_table(validated: DataFrame) -> DataFrame:
    """Long table (file_path, rule, valid, message); rows that were skipped have no rules."""
    return validated.select("file_path", F.inline("rules"))


def failed_rules(validated: DataFrame) -> DataFrame:
    return rule_table(validated).where("not valid")


# ---- rules over separate tables -------------------------------------------------------------------
KEY = "contract_number"


def first_winners(bidders: DataFrame, position: str = "position") -> DataFrame:
    """First bidder in document order that is flagged or ranked first; combines map-side."""
    return (
        bidders.where("coalesce(is_winner, false) or coalesce(bid_rank = 1, false)")
        .groupBy(KEY)
        .agg(F.min_by(F.struct("total_bid_amount", "bidder_name"), F.col(position)).alias("winner"))
    )


def contract_totals(contracts: DataFrame, bidders: DataFrame) -> DataFrame:
    joined = contracts.join(first_winners(bidders), KEY, "left")
    rule = totals_rule(
        F.col("awarded_amount"), F.col("awarded_to"), F.col("winner").isNotNull(), F.col("winner.total_bid_amount")
    )
    return joined.select(KEY, rule.alias("v")).select(KEY, "v.valid", "v.message")


def item_sums(items: DataFrame) -> DataFrame:
    return items.groupBy(KEY, F.coalesce("bidder_name", F.lit("unknown")).alias("bidder_name")).agg(
        F.sum(F.when(~falsy(F.col("total_price")), F.col("total_price"))).alias("items_sum")
    )


def item_mismatches(bidders: DataFrame, items: DataFrame) -> DataFrame:
    """One row per bidder whose items do not add up to its total, in contracts that have items."""
    with_items = items.groupBy(KEY).agg(F.count(F.lit(1)).alias("_items")).drop("_items")
    return (
        bidders.where(~falsy(F.col("bidder_name"), "text") & ~falsy(F.col("total_bid_amount")))
        .join(item_sums(items), [KEY, "bidder_name"], "left")
        .withColumn("items_sum", F.coalesce("items_sum", F.lit(0).cast("decimal(28,2)")))
        .where(_far(F.col("total_bid_amount"), F.col("items_sum"), ITEM_TOLERANCE))
        .join(with_items, KEY, "left_semi")
        .select(KEY, "position", "bidder_name", "total_bid_amount", "items_sum")
    )


def bid_items_sum(contracts: DataFrame, bidders: DataFrame, items: DataFrame) -> DataFrame:
    """Verdict per contract with the number of mismatching bidders; `item_mismatches` has the details."""
    n_bidders = bidders.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_bidders"))
    n_items = items.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_items"))
    wrong = item_mismatches(bidders, items).groupBy(KEY).agg(F.count(F.lit(1)).alias("n_wrong"))
    joined = contracts.select(KEY).join(n_bidders, KEY, "left").join(n_items, KEY, "left").join(wrong, KEY, "left")
    n_wrong = F.coalesce("n_wrong", F.lit(0))
    return joined.select(
        KEY,
        (n_wrong == 0).alias("valid"),
        n_wrong.alias("mismatches"),
        F.when(F.col("n_bidders").isNull() | F.col("n_items").isNull(), NO_ITEMS)
        .when(n_wrong == 0, ITEMS_OK)
        .otherwise("Bid items sum mismatch")
        .alias("message"),
    )


def bid_fences(bidders: DataFrame) -> DataFrame:
    """Per contract: number of bids, quartiles and number of bids outside the fences, for contracts of any size.

    Equal amounts are counted together first; the fences come from the exact ranks of the distinct amounts and are compared with them.
    """
    ranked = value_ranks(bidders, [KEY], "total_bid_amount")
    amount = F.col("_v").cast("double")
    step = FENCE * (F.col("q3") - F.col("q1"))
    outside = (amount < F.col("q1") - step) | (amount > F.col("q3") + step)
    fences = quantiles_of(ranked, [KEY], {"q1": 0.25, "q3": 0.75}).select(KEY, "n", "q1", "q3")
    return ranked.join(fences, KEY).groupBy(KEY).agg(
        F.max("n").alias("n"), F.max("q1").alias("q1"), F.max("q3").alias("q3"),
        F.sum(F.when(outside, F.col("_n")).otherwise(0)).alias("outliers"),
    )


def bidder_outliers(contracts: DataFrame, bidders: DataFrame) -> DataFrame:
    """Verdict per contract with its quartiles and the number of bids outside the fences."""
    joined = contracts.select(KEY).join(bid_fences(bidders), KEY, "left")
    few = F.coalesce("n", F.lit(0)) < MIN_BIDS
    flat = F.col("q1") == F.col("q3")
    count = F.when(few | flat, 0).otherwise(F.col("outliers"))
    return joined.select(
        KEY, "q1", "q3", count.alias("outliers"), (count == 0).alias("valid"),
        F.when(few, FEW_BIDS)
        .when(flat, NO_SPREAD)
        .when(count == 0, NO_OUTLIERS)
        .otherwise("Outlier bid totals detected")
        .alias("message"),
    )


def row_rule(contracts: DataFrame, rule: Column) -> DataFrame:
    return contracts.select(KEY, rule.alias("v")).select(KEY, "v.valid", "v.message")


def contract_dates(contracts: DataFrame) -> DataFrame:
    names: Sequence[str] = ("date_available", "completion_date", "bid_opening_date", "award_date")
    return row_rule(contracts, dates_rule(*(F.col(n) for n in names)))


def contract_goals(contracts: DataFrame) -> DataFrame:
    return row_rule(contracts, goals_rule(*(F.col(n) for n in ("mbe_goal", "wbe_goal", "combined_goal"))))
