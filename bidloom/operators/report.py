"""Run summaries, quality metrics and distributions over result or log tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.parse import percent_text
from ..functions.ranks import blocked_quantiles, quantiles_of, value_ranks

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def _is(status: str) -> Column:
    return F.count_if(F.col("status") == status)


def run_summary(results: DataFrame) -> DataFrame:
    """One row of totals; no row for an empty run. `partial` is counted apart from the parity columns."""
    counts = results.agg(
        F.count(F.lit(1)).alias("total_files"),
        _is("success").alias("successful"),
        _is("failed").alias("failed"),
        _is("skipped").alias("skipped"),
        _is("partial").alias("partial"),
    )
    return counts.where("total_files > 0").withColumn(
        "success_rate", percent_text(F.col("successful"), F.col("total_files"))
    )


def _type_counts() -> list[Column]:
    return [F.count(F.lit(1)).alias("total"), _is("success").alias("successful"), _is("failed").alias("failed")]


def summary_by_type(results: DataFrame) -> DataFrame:
    counts = results.groupBy("document_type").agg(*_type_counts())
    return counts.withColumn("success_rate", F.rint(F.col("successful") / F.col("total") * 100 * 10) / 10)


def summary_rollup(results: DataFrame) -> DataFrame:
    """Per type and overall in one pass."""
    rolled = results.rollup("document_type").agg(F.grouping_id().alias("level"), *_type_counts(), _is("skipped").alias("skipped"))
    return rolled.select(
        F.when(F.col("level") == 1, "ALL").otherwise(F.col("document_type")).alias("document_type"),
        "total", "successful", "failed", "skipped",
    )


def error_frequency(results: DataFrame) -> DataFrame:
    return (
        results.where("error is not null").groupBy("document_type", "error").agg(F.count(F.lit(1)).alias("occurrences"))
    )


def validation_summary(validated: DataFrame) -> DataFrame:
    """Over successful documents: total, valid, invalid, pass_rate (`N/A` for none)."""
    counts = validated.where("status = 'success'").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("valid")).alias("valid")
    )
    rate = F.when(F.col("total") > 0, percent_text(F.col("valid"), F.col("total"))).otherwise("N/A")
    return counts.select("total", "valid", (F.col("total") - F.col("valid")).alias("invalid"), rate.alias("pass_rate"))


def mean_completeness(results: DataFrame) -> DataFrame:
    """Mean of `completeness` (0..1) over successful documents, in percent."""
    done = results.where("status = 'success'")
    return done.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.avg("completeness"), F.lit(0.0)).alias("_m")).select(
        "documents", (F.col("_m") * 100).alias("avg_completeness")
    )


def timing_metrics(results: DataFrame, time: str = "processing_time") -> DataFrame:
    """Mean and total time; throughput counts every result, timed or not."""
    sums = results.agg(
        F.count(F.lit(1)).alias("results"), F.count(time).alias("timed"), F.sum(time).alias("total_time")
    )
    return sums.select(
        "results", "timed",
        F.coalesce("total_time", F.lit(0)).alias("total_time"),
        F.coalesce(F.try_divide("total_time", F.col("timed")), F.lit(0)).alias("avg_time"),
        F.try_divide(F.col("results"), F.col("total_time")).alias("throughput"),
    )


def describe_by_type(results: DataFrame, value: str) -> DataFrame:
    """count, mean, sample deviation, minimum, quartiles, maximum of a numeric column per document type.

    There are few types and many rows of each, so the quartiles come from the blocked form.
    """
    spread = results.where(F.col(value).isNotNull()).groupBy("document_type").agg(
        F.stddev_samp(F.col(value).cast("double")).alias("std")
    )
    return blocked_quantiles(results, ["document_type"], value, QUARTILES).join(spread, "document_type").select(
        "document_type", F.col("n").alias("count"), "mean", "std", F.col("lowest").alias("min"),
        *QUARTILES, F.col("highest").alias("max"),
    )


def boxplot_by_type(results: DataFrame, value: str) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 IQR) and the number of points outside."""
    ranked = value_ranks(results, ["document_type"], value)
    boxes = quantiles_of(ranked, ["document_type"], QUARTILES).withColumn("_iqr", F.col("p75") - F.col("p25"))
    number = F.col("_v").cast("double")
    inside = number.between(F.col("p25") - 1.5 * F.col("_iqr"), F.col("p75") + 1.5 * F.col("_iqr"))
    # equal values of a type are one row, so the few type keys carry little into the join
    return ranked.join(boxes, "document_type").groupBy("document_type").agg(
        F.first("p25").alias("q1"), F.first("p50").alias("median"), F.first("p75").alias("q3"),
        F.min(F.when(inside, number)).alias("whisker_low"),
        F.max(F.when(inside, number)).alias("whisker_high"),
        F.sum(F.when(~inside, F.col("_n")).otherwise(0)).alias("outliers"),
    )


def contract_coverage(results: DataFrame) -> DataFrame:
    """Distinct contracts and filled award and estimate amounts over the three contract-bearing types."""
    kinds = [S.INVITATION, S.AWARD, S.ITEM_C]
    kept = results.where(
        (F.col("status") == "success") & F.col("document_type").isin(*kinds) & F.col("contract_number").isNotNull()
    )
    # one group per key first: a plain distinct count would send a hot key's rows to one task unreduced
    per_key = kept.groupBy("contract_number").agg(F.count("awarded_amount").alias("a"), F.count("estimated_cost").alias("e"))
    return per_key.agg(
        F.count(F.lit(1)).alias("contracts"),
        F.coalesce(F.sum("a"), F.lit(0)).alias("with_award"),
        F.coalesce(F.sum("e"), F.lit(0)).alias("with_estimate"),
    )


def award_stats(contracts: DataFrame, value: str = "awarded_amount") -> DataFrame:
    stats = blocked_quantiles(contracts, [], value, {"median": 0.5})
    return stats.select(F.col("n").alias("count"), "mean", "median", F.col("lowest").alias("min"), F.col("highest").alias("max"))


def award_histogram(contracts: DataFrame, value: str = "awarded_amount", bins: int = 20) -> DataFrame:
    """Equal-width bins between minimum and maximum, the last one closed; empty bins are listed too."""
    filled = contracts.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("_x"))
    edges = filled.agg(F.struct(F.min("_x").alias("low"), F.max("_x").alias("high"))).scalar()
    low, high = edges["low"], edges["high"]
    share = F.try_divide(F.col("_x") - low, high - low)
    at = F.least(F.lit(bins - 1), F.floor(F.coalesce(share, F.lit(0.0)) * bins))
    counts = filled.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
    width = (high - low) / bins
    frame = contracts.sparkSession.range(bins).select(
        F.col("id").alias("bin"), (low + width * F.col("id")).alias("bin_start"), (low + width * (F.col("id") + 1)).alias("bin_end")
    )
    return frame.where("bin_start is not null").join(counts, "bin", "left").select(
        "bin", "bin_start", "bin_end", F.coalesce("_n", F.lit(0)).alias("frequency")
    )


def items_report(results: DataFrame) -> DataFrame:
    """Number of bid items per bid-tab document, zeros included."""
    return results.where(F.col("document_type") == S.BID_TABS).select(
        "file_path", F.col("data.contract_number").alias("contract_number"),
        F.greatest(F.coalesce(F.size("data.bid_items"), F.lit(0)), F.lit(0)).alias("bid_items_count"),
    )


def bid_ranking(bidders: DataFrame, contracts: DataFrame) -> DataFrame:
    """Rank by amount within the contract, with percent over the low bid and over the estimate.

    The rank counts strictly lower bids, equal bids share it. It is found per distinct amount; the low bid of a contract, which is the
    amount without lower ones, and its estimate come as one row a contract.
    """
    key = "contract_number"
    ranked = value_ranks(bidders, [key], "total_bid_amount")
    low = ranked.where("_first = 0").select(key, F.col("_v").alias("low_bid"))
    bases = contracts.select(key, "estimated_cost").join(low, key, "full_outer")
    amount = F.col("total_bid_amount").cast("double")

    def over(base: str) -> Column:
        return F.try_divide(amount - F.col(base).cast("double"), F.col(base).cast("double")) * 100

    places = ranked.select(key, F.col("_v").alias("total_bid_amount"), (F.col("_first") + 1).alias("rank"))
    return (
        bidders.join(places, [key, "total_bid_amount"], "left").join(bases, key, "left")
        .select(key, "bidder_name", "total_bid_amount", "rank",
                over("low_bid").alias("over_low"), over("estimated_cost").alias("over_estimate"))
    )


def sample_results(results: DataFrame, n: int = 3, fields: int = 5) -> DataFrame:
    """First n results by path with the filled ones among their first data fields, as the console shows."""
    data = F.col("data")
    shown = []
    for name, kind in S.FIELD_TYPES.items():
        value, text = data[name], data[name].cast("string")
        if kind.startswith("array"):
            filled, text = F.size(value) > 0, F.concat(F.size(value).cast("string"), F.lit(" rows"))
        elif kind == "string":
            filled = value != ""
        elif kind == "double" or kind.startswith("decimal"):
            filled = value != 0
        else:
            filled = value.isNotNull()
        kinds = [t for t, names in S.EXPECTED_FIELDS.items() if name in names[:fields]]
        if kinds:
            shown.append(F.when(F.col("document_type").isin(*kinds) & filled, F.concat(F.lit(f"{name}: "), text)))
    return (
        results.orderBy("file_path").limit(n)
        .select("file_path", "file_name", "document_type", "status",
                F.array_join(F.array_compact(F.array(*shown)), "; ").alias("fields"), "error")
    )
