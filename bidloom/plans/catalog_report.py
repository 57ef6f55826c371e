"""Queries: summaries, metrics, distributions, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import report as R
from ..session import fresh_path
from ..sources.pages import documents
from ..streaming import ingest as ST
from ..streaming.gather import whole_documents
from . import bidstar as star
from .registry import query

DOUBLE = "double"


def _round(df, digits: int, *names: str):
    for n in names:
        df = df.withColumn(n, F.round(F.col(n).cast(DOUBLE), digits))
    return df


@query("""SELECT count(*) AS total_files, count(*) FILTER (status = 'success') AS successful, count(*) FILTER (status = 'failed') AS failed,
  count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'partial') AS partial,
  format('{:.1f}%', count(*) FILTER (status = 'success') / count(*) * 100) AS success_rate FROM r""")
def run_summary(spark, sf_dir):
    return R.run_summary(star.run_log(spark, sf_dir))


@query("""SELECT document_type, count(*) AS total, count(*) FILTER (status = 'success') AS successful,
  count(*) FILTER (status = 'failed') AS failed, round_even(count(*) FILTER (status = 'success') / count(*) * 100, 1) AS success_rate
  FROM r GROUP BY 1""")
def summary_by_type(spark, sf_dir):
    return R.summary_by_type(star.run_log(spark, sf_dir))


@query("""SELECT coalesce(document_type, 'ALL') AS document_type, count(*) AS total, count(*) FILTER (status = 'success') AS successful,
  count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'skipped') AS skipped FROM r GROUP BY ROLLUP (document_type)""")
def summary_rollup(spark, sf_dir):
    return R.summary_rollup(star.run_log(spark, sf_dir))


@query("SELECT document_type, error, count(*) AS occurrences FROM r WHERE error IS NOT NULL GROUP BY 1, 2")
def error_frequency(spark, sf_dir):
    return R.error_frequency(star.run_log(spark, sf_dir))


@query("""SELECT count(*) AS documents, round(CAST(sum(completeness) AS DOUBLE) / count(*) * 100, 4) AS avg_completeness
  FROM r WHERE status = 'success'""")
def completeness_avg(spark, sf_dir):
    return _round(R.mean_completeness(star.run_log(spark, sf_dir)), 4, "avg_completeness")


@query("""SELECT count(*) AS results, count(processing_time) AS timed, CAST(sum(processing_time) AS DOUBLE) AS total_time,
  round(CAST(sum(processing_time) AS DOUBLE) / count(processing_time), 6) AS avg_time,
  round(count(*) / CAST(sum(processing_time) AS DOUBLE), 6) AS throughput FROM r""")
def timing_metrics(spark, sf_dir):
    m = R.timing_metrics(star.run_log(spark, sf_dir))
    return _round(m, 6, "avg_time", "throughput").withColumn("total_time", F.col("total_time").cast(DOUBLE))


DESCRIBE_SQL = """SELECT document_type, count(x) AS count, round(CAST(sum(x) AS DOUBLE) / count(x), 4) AS mean,
  round(stddev_samp(CAST(x AS DOUBLE)), 5) AS std, CAST(min(x) AS DOUBLE) AS min, round(quantile_cont(CAST(x AS DOUBLE), 0.25), 5) AS p25,
  round(quantile_cont(CAST(x AS DOUBLE), 0.5), 5) AS p50, round(quantile_cont(CAST(x AS DOUBLE), 0.75), 5) AS p75,
  CAST(max(x) AS DOUBLE) AS max FROM (SELECT document_type, {x} AS x FROM r) WHERE x IS NOT NULL GROUP BY 1"""


def _timed_log(spark, sf_dir):
    """The run log with times as a pipeline records them: seconds as doubles of six digits."""
    log = star.run_log(spark, sf_dir)
    number = F.regexp_extract("file_path", r"(\d+)", 1).cast("bigint")
    return log.withColumn("processing_time", F.col("processing_time").cast(DOUBLE) + (number % 1000) / 1000000.0)


@query(DESCRIBE_SQL.format(x="CAST(processing_time AS DOUBLE) + (event_id % 1000) / 1000000.0"))
def describe_time_by_type(spark, sf_dir):
    d = R.describe_by_type(_timed_log(spark, sf_dir), "processing_time")
    return _round(_round(d, 5, "std", "p25", "p50", "p75"), 4, "mean")


@query(DESCRIBE_SQL.format(x="CASE WHEN status = 'success' THEN completeness END"))
def describe_completeness_by_type(spark, sf_dir):
    done = star.run_log(spark, sf_dir).where("status = 'success'")
    return _round(_round(R.describe_by_type(done, "completeness"), 5, "std", "p25", "p50", "p75"), 4, "mean")


@query("""SELECT document_type, round(q1, 5) AS q1, round(median, 5) AS median, round(q3, 5) AS q3, min(x) FILTER (inside) AS whisker_low,
  max(x) FILTER (inside) AS whisker_high, count(*) FILTER (NOT inside) AS outliers FROM (
    SELECT *, x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM
      (SELECT document_type, CAST(processing_time AS DOUBLE) AS x FROM r WHERE processing_time IS NOT NULL) JOIN (
      SELECT document_type, quantile_cont(CAST(processing_time AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(processing_time AS DOUBLE), 0.5) AS median,
        quantile_cont(CAST(processing_time AS DOUBLE), 0.75) AS q3 FROM r GROUP BY 1) USING (document_type)) GROUP BY 1, 2, 3, 4""")
def boxplot_by_type(spark, sf_dir):
    return _round(R.boxplot_by_type(star.run_log(spark, sf_dir), "processing_time"), 5, "q1", "median", "q3")


def _contract_results(spark, sf_dir):
    """One result per contract: type by key, every fifth without a key, every eighth not successful."""
    k = F.col("k")
    kind = F
    for n, name in enumerate(["invitation_to_bid", "award_letter", "item_c_report", "bid_tabs"]):
        kind = kind.when(k % 4 == n, F.lit(name))
    c = star.contracts(spark, sf_dir)
    return c.select(
        kind.alias("document_type"), F.when(k % 8 == 5, "failed").otherwise("success").alias("status"),
        F.when(k % 5 != 0, F.col("wbs_element")).alias("contract_number"),
        F.when(k % 4 == 1, F.col("awarded_amount")).alias("awarded_amount"),
        F.when(k % 4 == 2, F.col("estimated_cost")).alias("estimated_cost"),
    )


@query("""SELECT count(DISTINCT wbs_element) AS contracts, count(CASE WHEN k % 4 = 1 THEN awarded_amount END) AS with_award,
  count(CASE WHEN k % 4 = 2 THEN estimated_cost END) AS with_estimate FROM o WHERE k % 4 <> 3 AND k % 8 <> 5 AND k % 5 <> 0""")
def contract_coverage(spark, sf_dir):
    return R.contract_coverage(_contract_results(spark, sf_dir))


@query("""SELECT count(awarded_amount) AS count, round(CAST(sum(awarded_amount) AS DOUBLE) / count(awarded_amount), 4) AS mean,
  round(quantile_cont(CAST(awarded_amount AS DOUBLE), 0.5), 4) AS median, CAST(min(awarded_amount) AS DOUBLE) AS min,
  CAST(max(awarded_amount) AS DOUBLE) AS max FROM o""")
def award_stats(spark, sf_dir):
    return _round(R.award_stats(star.contracts(spark, sf_dir)), 4, "mean", "median")


@query("""SELECT CAST(i AS BIGINT) AS bin, round(lo + (hi - lo) / 20 * i, 4) AS bin_start, round(lo + (hi - lo) / 20 * (i + 1), 4) AS bin_end,
  coalesce(n, 0) AS frequency FROM (SELECT unnest(range(20)) AS i) CROSS JOIN
  (SELECT CAST(min(awarded_amount) AS DOUBLE) AS lo, CAST(max(awarded_amount) AS DOUBLE) AS hi FROM o) LEFT JOIN (
    SELECT least(19, CAST(floor((CAST(awarded_amount AS DOUBLE) - l) / (h - l) * 20) AS BIGINT)) AS i, count(*) AS n FROM o CROSS JOIN
      (SELECT CAST(min(awarded_amount) AS DOUBLE) AS l, CAST(max(awarded_amount) AS DOUBLE) AS h FROM o)
    WHERE awarded_amount IS NOT NULL GROUP BY 1) USING (i)""")
def award_histogram(spark, sf_dir):
    return _round(R.award_histogram(star.contracts(spark, sf_dir)), 4, "bin_start", "bin_end")


@query("""SELECT b.contract_number, bidder_name, CAST(total_bid_amount AS DOUBLE) AS total_bid_amount,
  rank() OVER (PARTITION BY b.contract_number ORDER BY total_bid_amount) AS rank,
  round((CAST(total_bid_amount AS DOUBLE) - CAST(low_bid AS DOUBLE)) / CAST(low_bid AS DOUBLE) * 100, 4) AS over_low,
  round((CAST(total_bid_amount AS DOUBLE) - CAST(estimated_cost AS DOUBLE)) / CAST(estimated_cost AS DOUBLE) * 100, 4) AS over_estimate
  FROM b JOIN low USING (k) LEFT JOIN o ON o.contract_number = b.contract_number""")
def bid_ranking(spark, sf_dir):
    ranked = R.bid_ranking(star.bidders(spark, sf_dir), star.contracts(spark, sf_dir))
    return _round(_round(ranked, 4, "over_low", "over_estimate"), 2, "total_bid_amount")


# ---- streams --------------------------------------------------------------------------------------------------------
def _event_stream(spark, sf_dir):
    path = f"{sf_dir}/events.parquet"
    # as a glob the path may be one file as well as a folder of part files
    return ST.landing_stream(spark, f"{path}*", spark.read.parquet(path).schema)


@query("SELECT document_type, status, count(*) AS results FROM r GROUP BY 1, 2")
def stream_status_counts(spark, sf_dir):
    """Landing folder in micro-batches; each batch writes partial counts, which add up."""
    partial = ST.collect_batches(
        _event_stream(spark, sf_dir),
        lambda df: star.log_of(df).groupBy("document_type", "status").agg(F.count(F.lit(1)).alias("results")),
        "status-counts",
    )
    return ST.counts_from_batches(partial, ["document_type", "status"])


@query("SELECT document_type, count(*) AS results, CAST(sum(processing_time) AS DOUBLE) AS total_time FROM r GROUP BY 1")
def stream_dedup(spark, sf_dir):
    """Every result is delivered twice, the second time an hour later with another processing time; the first counts."""
    def twice(df):
        log = star.log_of(df)
        later = log.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 HOUR")).withColumn(
            "processing_time", (F.col("processing_time") + 1).cast("decimal(10,2)"))
        return later.unionByName(log)

    table = ST.first_deliveries(_event_stream(spark, sf_dir), twice, ["file_path"], ["ts"], "dedup")
    return table.groupBy("document_type").agg(
        F.count(F.lit(1)).alias("results"), F.sum("processing_time").cast(DOUBLE).alias("total_time"))


@query("""SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, document_type, count(*) AS results,
  count(*) FILTER (status = 'success') AS successful, count(*) FILTER (status = 'failed') AS failed,
  CAST(sum(processing_time) AS DOUBLE) AS total_time FROM r GROUP BY 1, 2""")
def stream_window_counts(spark, sf_dir):
    """Daily counts, those of the days still open included: partial counts of the batches, added up."""
    partial = ST.collect_batches(
        _event_stream(spark, sf_dir), lambda df: ST.window_counts(star.log_of(df), "ts", "1 day"), "windows")
    table = ST.counts_from_batches(partial, ["window_start", "document_type"])
    return table.select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "document_type", "results", "successful", "failed",
        F.col("total_time").cast(DOUBLE).alias("total_time"))


@query("""SELECT 'conv/' || doc_id AS file_path, count(*) AS page_count, count(*) FILTER (NOT blank) AS pages_with_content,
  sha256(string_agg(text, chr(10) ORDER BY page_no) || chr(10)) AS text_sha256 FROM p GROUP BY doc_id""")
def gathered_pages(spark, sf_dir):
    """Pages of each document land in three deliveries, a run after each; some pages come twice. Every document comes out once, whole."""
    pages = star.pages(spark, sf_dir)
    counts = pages.groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("page_count"))
    rows = pages.join(counts, "doc_id").select(
        F.concat(F.lit("conv/"), F.col("doc_id").cast("string")).alias("file_path"), "page_no", "text",
        F.when(F.col("page_no") % 2 == 0, F.col("page_count")).alias("page_count"))
    land, home = fresh_path(spark, "landing"), fresh_path(spark, "gathered")
    ST.use_rocksdb(spark)
    for delivery in (2, 0, 1):
        again = F.col("page_no") % 5 == delivery
        rows.where((F.col("page_no") % 3 == delivery) | again).write.mode("append").parquet(land)
        stream = whole_documents(ST.landing_stream(spark, land, rows.schema))
        done = ST.collect_batches(stream, lambda df: df, "gathered", home, idle=False)
    docs = documents(done.where("page_error is null"), ["file_path", "file_version"])
    return docs.select("file_path", "page_count", "pages_with_content", F.sha2("text", 256).alias("text_sha256"))
