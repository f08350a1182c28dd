"""Corpus questions: counters, growth, sizes, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skein.functions import ids, text


def share(n: Column, total: Column, digits: int = 2) -> Column:
    """Percentage, rounded half to even."""
    return F.bround(F.try_divide(F.lit(100.0) * n, total), digits)


def status_counts(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("status").agg(F.count("*").alias("n"), F.count_if("low_text").alias("low_text"))


def counters(papers: DataFrame) -> dict[str, DataFrame]:
    """Eleven aggregates of normalised papers; archives count once for each paper, undated papers have no month."""
    month = F.substring(F.col("date_released").cast("string"), 1, 7)
    archives = F.array_distinct(F.transform("categories", ids.archive_of))
    dated = papers.where("date_released is not null").select(month.alias("month"), F.year("date_released").alias("year"), F.explode(archives).alias("archive"))
    pairs = papers.select(F.array_sort(F.array_distinct("categories")).alias("c"))
    first = pairs.select("c", F.posexplode("c").alias("i", "a")).select("a", F.explode(F.slice("c", F.col("i") + 2, F.size("c"))).alias("b"))
    is_missing = lambda c: F.count_if(F.col(c).isNull() | (F.col(c).cast("string") == ""))
    return {
        "primary": papers.where("primary_category <> ''").groupBy(F.col("primary_category").alias("category")).count(),
        "all": papers.select(F.explode("categories").alias("category")).groupBy("category").count(),
        "n_categories": papers.groupBy(F.size("categories").alias("n_categories")).count(),
        "cooccurrence": first.groupBy("a", "b").count(),
        "monthly": papers.where("date_released is not null").groupBy(month.alias("month")).count(),
        "archive_month": dated.groupBy("archive", "month").count(),
        "archive_year": dated.groupBy("archive", "year").count(),
        "n_versions": papers.groupBy("n_versions").count(),
        "title_length": papers.groupBy(text.width_bucket(F.length("title"), 10).alias("chars")).count(),
        "missing": papers.agg(is_missing("doi").alias("doi"), is_missing("date_released").alias("date_released")),
        "summary": papers.agg(F.count("*").alias("papers"), F.sum(F.size("categories")).alias("assignments"), F.min(month).alias("first_month"), F.max(month).alias("last_month")),
    }


def cross_listing(primary: DataFrame, every: DataFrame) -> DataFrame:
    """Primary and all assignments of each category side by side; the ratio is null without primary papers."""
    j = primary.withColumnRenamed("count", "n_primary").join(every.withColumnRenamed("count", "n_all"), "category", "full_outer")
    j = j.select("category", F.coalesce("n_primary", F.lit(0)).alias("n_primary"), F.coalesce("n_all", F.lit(0)).alias("n_all"))
    return j.withColumn("ratio", F.bround(F.try_divide(F.col("n_all"), F.col("n_primary")), 3))


def weighted_means(papers: DataFrame) -> DataFrame:
    """One row from one pass: categories a paper, mean length of titles, share of papers never revised."""
    n = F.greatest(F.count("*"), F.lit(1))
    return papers.agg((F.sum(F.size("categories")) / n).alias("categories_per_paper"), (F.sum(F.length("title")) / n).alias("mean_title"), (F.count_if(F.col("n_versions") == 1) / n).alias("never_revised"))


def centred_mean(series: DataFrame, order: str, value: str, before: int = 6, after: int = 5) -> DataFrame:
    """Rolling mean over a full window around each row, null where it isn't full. One row a period: small by nature."""
    w = W.orderBy(order).rowsBetween(-before, after)
    return series.withColumn("rolling", F.when(F.count(value).over(w) == before + after + 1, F.avg(value).over(w)))


def trailing_mean(series: DataFrame, key: str, month: str, value: str, width: int = 12) -> DataFrame:
    """Trailing mean for each key over a complete grid of months; missing months count zero.

    The grid is keys times months, both aggregates; it is built by exploding the month range of the whole series.
    """
    bounds = series.agg(F.min(month).alias("low"), F.max(month).alias("high"))
    step = F.expr("interval 1 month")
    grid = series.select(key).distinct().join(F.broadcast(bounds)).select(key, F.explode(F.sequence("low", "high", step)).alias(month))
    full = grid.join(series, [key, month], "left").withColumn(value, F.coalesce(value, F.lit(0)))
    return full.withColumn("rolling", F.avg(value).over(W.partitionBy(key).orderBy(month).rowsBetween(1 - width, 0)))


def floor_percentiles(values: DataFrame, column: str, points: tuple[float, ...] = (0.1, 0.5, 0.9, 0.99)) -> DataFrame:
    """ordered[min(n - 1, int(q * n))] for each q, without a global window.

    Values are counted by value; running counts come from a range-partitioned sort with per-range
    offsets (one row a range), so no task sees all values.
    """
    counted = values.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    placed = counted.repartitionByRange("v").withColumn("r", F.spark_partition_id())
    sums = placed.groupBy("r").agg(F.sum("n").alias("s"), F.min("v").alias("low"), F.max("v").alias("high"))
    total = counted.agg(F.sum("n")).first()[0]
    if not total:
        return values.sparkSession.createDataFrame([], f"q double, value {dict(counted.dtypes)['v']}")
    targets = values.sparkSession.createDataFrame([(q, min(total - 1, int(q * total))) for q in points], "q double, target long")
    before = F.coalesce(F.sum("s").over(W.orderBy("low").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranges = sums.withColumn("before", before)
    hit = ranges.join(F.broadcast(targets), (F.col("target") >= F.col("before")) & (F.col("target") < F.col("before") + F.col("s")))
    inside = counted.join(F.broadcast(hit), (F.col("v") >= F.col("low")) & (F.col("v") <= F.col("high")))
    run = F.col("before") + F.sum("n").over(W.partitionBy("q").orderBy("v"))
    return inside.withColumn("run", run).where("run > target").groupBy("q").agg(F.min("v").alias("value"))


def size_rows(manifest: DataFrame) -> DataFrame:
    """Bytes in and out of done papers; text is Markdown plus tables, the ratio 0 without text."""
    t = F.coalesce("md_bytes", F.lit(0)) + F.coalesce("tables_bytes", F.lit(0))
    rows = manifest.where("status = 'done' and md_bytes is not null and pdf_bytes is not null").withColumn("text_bytes", t)
    return rows.select("arxiv_id", F.coalesce("primary_category", F.lit("?")).alias("category"), F.coalesce("pdf_bytes", F.lit(0)).alias("pdf_bytes"), "text_bytes", F.when(t != 0, F.col("pdf_bytes") / t).otherwise(0.0).alias("ratio"))


def size_report(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count("*").alias("papers"), F.sum("pdf_bytes").alias("pdf_total"), F.sum("text_bytes").alias("text_total"), F.avg("pdf_bytes").alias("pdf_mean"), F.median("pdf_bytes").alias("pdf_median"),
        F.median("text_bytes").alias("text_median"), F.try_divide(F.sum("pdf_bytes"), F.sum("text_bytes")).alias("overall_ratio"),
    )


def sizes_by_category(rows: DataFrame, top: int | None = None) -> DataFrame:
    out = rows.groupBy("category").agg(F.count("*").alias("papers"), F.sum("pdf_bytes").alias("pdf_bytes"), F.sum("text_bytes").alias("text_bytes"))
    out = out.withColumn("ratio", F.coalesce(F.try_divide("pdf_bytes", "text_bytes"), F.lit(0.0))).orderBy(F.desc("papers"), "category")
    return out if top is None else out.limit(top)


def top_n(counted: DataFrame, n: int, by: str = "count", *ties: str) -> DataFrame:
    return counted.orderBy(F.desc(by), *ties).limit(n)


def keep_top(rows: DataFrame, key: str, top: DataFrame) -> DataFrame:
    return rows.join(F.broadcast(top.select(key)), key, "left_semi")


def crawl_plan(papers: int, rps: float, pdf_bytes: int = 2_000_000, md_bytes: int = 98_900) -> dict[str, float]:
    """Hours at a request rate, gigabytes to fetch and to keep."""
    return {"papers": papers, "hours": papers / rps / 3600, "pdf_gb": papers * pdf_bytes / 1e9, "pdf_tb": papers * pdf_bytes / 1e12, "md_gb": papers * md_bytes / 1e9}


def extrapolate(rows: DataFrame, corpus: int = 2_800_000) -> DataFrame:
    """Totals of a sample carried on to a corpus."""
    scale = F.lit(float(corpus)) / F.count("*")
    return rows.agg((F.sum("pdf_bytes") * scale).alias("pdf_bytes"), (F.sum("text_bytes") * scale).alias("text_bytes"))


def run_tallies(events: DataFrame) -> DataFrame:
    """Outcomes of a run: processed, done, no_pdf, failed, retried, fell back, upgraded."""
    s = F.col("status")
    return events.agg(
        F.count("*").alias("processed"), F.count_if(s == "done").alias("done"), F.count_if(s == "no_pdf").alias("no_pdf"), F.count_if(s.startswith("failed")).alias("failed"),
        F.count_if(F.col("attempt") > 1).alias("retried"), F.count_if("fell_back").alias("fell_back"), F.count_if(F.col("upgrade") & (s == "done")).alias("upgraded"),
    )


def worker_states(events: DataFrame, slot: str = "slot") -> DataFrame:
    """One checkpoint row for each worker: processed, done, failed, no_pdf, the last paper and when it came."""
    s, kept = F.col("status"), events.where("status = 'done' or status = 'no_pdf' or status like 'failed%'")
    return kept.groupBy(slot).agg(
        F.count("*").alias("processed"), F.count_if(s == "done").alias("done"), F.count_if(s.startswith("failed")).alias("failed"), F.count_if(s == "no_pdf").alias("no_pdf"),
        F.max_by("paper", F.struct("ts", "seq")).alias("last_paper"), F.max("ts").alias("updated_at"),
    )


def error_sample(errors: DataFrame, order: str, message: str, n: int = 20) -> DataFrame:
    """The first n messages, for a report."""
    return errors.where(F.col(message).isNotNull()).orderBy(order).limit(n).select(order, message)


def median_step(series: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """(key, step): the median of the first differences of each series."""
    steps = series.withColumn("step", F.col(value) - F.lag(value).over(W.partitionBy(key).orderBy(order)))
    return steps.groupBy(key).agg(F.median("step").alias("step"))


def worker_totals(workers: DataFrame) -> DataFrame:
    return workers.agg(*(F.sum(c).alias(c) for c in ("processed", "done", "failed", "no_pdf")))


def repeated_errors(errors: DataFrame, key: str = "doc", at: str = "pos", message: str = "msg") -> DataFrame:
    """'message (xN)' in order of first appearance, joined for each key."""
    one = errors.groupBy(key, message).agg(F.count("*").alias("n"), F.min(at).alias("first"))
    shown = F.concat(F.col(message), F.when(F.col("n") > 1, F.format_string(" (x%d)", "n")).otherwise(""))
    listed = one.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("first", shown.alias("shown")))).alias("l"))
    return listed.select(key, F.array_join(F.transform("l", lambda x: x["shown"]), "; ").alias("errors"))


def fallback_runs(results: DataFrame, key: str, order: str, flag: str, alarm: int = 10) -> DataFrame:
    """Length of the current run of fallbacks at each row, and whether it reaches the alarm."""
    w = W.partitionBy(key).orderBy(order)
    marked = results.withColumn("island", F.sum(F.when(F.col(flag), 0).otherwise(1)).over(w.rowsBetween(W.unboundedPreceding, 0)))
    run = F.sum(F.when(F.col(flag), 1).otherwise(0)).over(W.partitionBy(key, "island").orderBy(order).rowsBetween(W.unboundedPreceding, 0))
    return marked.withColumn("run", run).withColumn("alarm", F.col("run") >= alarm).drop("island")


def cooldown_ladder(answers: DataFrame, key: str, order: str, bad: str, initial: int = 3600, cap: int = 21600) -> DataFrame:
    """Seconds of pause after each bad answer: doubled for each one in a row, reset by a good one."""
    runs = fallback_runs(answers, key, order, bad)
    pause = F.when(F.col(bad), F.least(F.lit(initial) * F.pow(F.lit(2.0), F.col("run") - 1), F.lit(cap)).cast("long"))
    return runs.withColumn("pause", pause).drop("alarm")


def compare_converters(rows: DataFrame) -> DataFrame:
    """Each converter's papers, tables, papers with tables, thin texts, and the paper of which it kept most."""
    return rows.groupBy("converter").agg(
        F.count("*").alias("papers"), F.sum("n_tables").alias("tables"), F.count_if(F.col("n_tables") > 0).alias("with_tables"), F.count_if("low_text").alias("thin"),
        F.max_by("arxiv_id", F.struct("n_chars", "doc_id")).alias("longest"),
    )


def progress(workers: DataFrame, seconds: float) -> DataFrame:
    """One row: totals of the workers and papers a minute."""
    done = F.sum("done")
    return workers.agg(F.sum("processed").alias("processed"), done.alias("done"), F.sum("failed").alias("failed"), F.bround(done / F.lit(seconds) * 60, 2).alias("per_minute"))
