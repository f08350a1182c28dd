"""Queries of the corpus: scope, counters, growth, sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skein.functions import ids, text
from skein.operators import analytics as an
from skein.operators import prepare
from skein.plans.derived import PAPERS, papers
from skein.plans.registry import query
from skein.session import table

Q = f"with {PAPERS}\n"


@query(Q + """select shard, bucket, count(*) as papers, sum(n_chars)::bigint as chars, sum(sum(n_chars)) over (partition by shard order by bucket)::bigint as running
from papers group by shard, bucket""")
def shard_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = papers(spark, sf_dir).groupBy("shard", "bucket").agg(F.count("*").alias("papers"), F.sum("n_chars").alias("chars"))
    return g.withColumn("running", F.sum("chars").over(W.partitionBy("shard").orderBy(F.asc_nulls_last("bucket"))))


@query(Q + """select arxiv_id, primary_category, date_released from papers where list_has_any(categories, ['en.src1', 'de', 'fr.src2'])
and strftime(date_released, '%Y-%m') between '2007-03' and '2009-06'""")
def scope_any_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.in_scope(papers(spark, sf_dir), ["en.src1", "de", "fr.src2"], date_from="2007-03", date_to="2009-06").select("arxiv_id", "primary_category", "date_released")


@query(Q + "select arxiv_id, primary_category from papers where primary_category in ('en.src1', 'es.src3') order by arxiv_id limit 25")
def scope_primary_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.in_scope(papers(spark, sf_dir), ["en.src1", "es.src3"], primary_only=True, max_papers=25).select("arxiv_id", "primary_category")


def _counter(name: str):  # noqa: ANN202
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return an.counters(papers(spark, sf_dir))[name]

    run.__name__ = f"counter_{name}"
    return run


for _name, _sql in {
    "primary": "select primary_category as category, count(*) as count from papers group by 1",
    "all": "select category, count(*) as count from (select unnest(categories) as category from papers) group by 1",
    "n_categories": "select len(categories)::int as n_categories, count(*) as count from papers group by 1",
    "cooccurrence": """, e as (select doc_id, unnest(list_distinct(categories)) as c from papers)
select x.c as a, y.c as b, count(*) as count from e x join e y on x.doc_id = y.doc_id and x.c < y.c group by 1, 2""",
    "monthly": "select strftime(date_released, '%Y-%m') as month, count(*) as count from papers where date_released is not null group by 1",
    "archive_month": """, a as (select strftime(date_released, '%Y-%m') as month, unnest(list_distinct(list_transform(categories, lambda c: string_split(c, '.')[1]))) as archive from papers where date_released is not null)
select archive, month, count(*) as count from a group by 1, 2""",
    "archive_year": """, a as (select year(date_released)::int as year, unnest(list_distinct(list_transform(categories, lambda c: string_split(c, '.')[1]))) as archive from papers where date_released is not null)
select archive, year, count(*) as count from a group by 1, 2""",
    "n_versions": "select n_versions, count(*) as count from papers group by 1",
    "title_length": "select (length(title) // 10 * 10)::bigint as chars, count(*) as count from papers group by 1",
    "missing": "select count(*) filter (where coalesce(doi, '') = '') as doi, count(*) filter (where date_released is null) as date_released from papers",
    "summary": "select count(*) as papers, sum(len(categories))::bigint as assignments, min(strftime(date_released, '%Y-%m')) as first_month, max(strftime(date_released, '%Y-%m')) as last_month from papers",
}.items():
    query(Q + _sql)(_counter(_name))


@query(Q + """, p as (select primary_category as category, count(*) as n from papers group by 1), a as (select category, count(*) as n from (select unnest(categories) as category from papers) group by 1)
select category, coalesce(p.n, 0) as n_primary, coalesce(a.n, 0) as n_all, round_even(a.n / nullif(p.n, 0)::double, 3) as ratio from p full join a using (category)""")
def cross_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = an.counters(papers(spark, sf_dir))
    return an.cross_listing(c["primary"], c["all"])


@query(Q + """select category, n, round_even(100.0 * n / sum(n) over (), 2)::double as share from (select primary_category as category, count(*) as n from papers group by 1) order by n desc, category limit 40""")
def top_categories_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = papers(spark, sf_dir)
    counted = an.counters(p)["primary"].withColumnRenamed("count", "n")
    total = counted.agg(F.sum("n").alias("total"))
    return an.top_n(counted, 40, "n", "category").join(F.broadcast(total)).select("category", "n", an.share(F.col("n"), F.col("total")).alias("share"))


@query(Q + """select archive, sum(n)::bigint as papers from (select string_split(primary_category, '.')[1] as archive, count(*) as n from papers group by primary_category) group by 1""")
def archive_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.counters(papers(spark, sf_dir))["primary"].groupBy(ids.archive_of(F.col("category")).alias("archive")).agg(F.sum("count").alias("papers"))


@query(Q + """, e as (select doc_id, unnest(categories) as category from papers)
select e.doc_id, e.category from e semi join (select category from e group by 1 order by count(*) desc, category limit 5) t on e.category = t.category""")
def keep_top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = papers(spark, sf_dir).select("doc_id", F.explode("categories").alias("category"))
    return an.keep_top(rows, "category", an.top_n(rows.groupBy("category").count(), 5, "count", "category")).select("doc_id", "category")


@query("""with m as (select date_trunc('month', o_orderdate)::date as month, count(*) as n from orders group by 1)
select month, n, case when count(*) over w = 12 then avg(n) over w end as rolling from m window w as (order by month rows between 6 preceding and 5 following)""")
def monthly_centred_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "orders").groupBy(F.trunc("o_orderdate", "month").alias("month")).agg(F.count("*").alias("n"))
    return an.centred_mean(m, "month", "n")


@query("""with m as (select o_orderpriority as key, date_trunc('month', o_orderdate)::date as month, count(*) as n from orders group by 1, 2),
b as (select min(month) as low, max(month) as high from m), g as (select key, unnest(generate_series(low, high, interval 1 month))::date as month from (select distinct key from m), b)
select g.key, g.month, coalesce(m.n, 0) as n, avg(coalesce(m.n, 0)) over (partition by g.key order by g.month rows between 11 preceding and current row) as rolling from g left join m on m.key = g.key and m.month = g.month""")
def monthly_trailing_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("key"), F.trunc("o_orderdate", "month").alias("month")).agg(F.count("*").alias("n"))
    return an.trailing_mean(m, "key", "month", "n")


@query("""with o as (select n_chars as v, row_number() over (order by n_chars) - 1 as r, count(*) over () as n from documents)
select q::double as q, v as value from o, (values (0.1), (0.5), (0.9), (0.99)) t(q) where r = least(n - 1, floor(q::double * n))""")
def floor_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.floor_percentiles(table(spark, sf_dir, "documents"), "n_chars")


SIZES = """, s as (select coalesce(primary_category, '?') as category, coalesce(pdf_bytes, 0) as pdf_bytes, coalesce(md_bytes, 0) + coalesce(tables_bytes, 0) as text_bytes from papers where status = 'done' and md_bytes is not null and pdf_bytes is not null)"""


@query(Q + SIZES + """select count(*) as papers, sum(pdf_bytes)::bigint as pdf_total, sum(text_bytes)::bigint as text_total, avg(pdf_bytes) as pdf_mean, median(pdf_bytes)::double as pdf_median,
median(text_bytes)::double as text_median, sum(pdf_bytes) / sum(text_bytes)::double as overall_ratio from s""")
def size_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.size_report(an.size_rows(papers(spark, sf_dir)))


@query(Q + SIZES + """select category, count(*) as papers, sum(pdf_bytes)::bigint as pdf_bytes, sum(text_bytes)::bigint as text_bytes, coalesce(sum(pdf_bytes) / nullif(sum(text_bytes), 0)::double, 0.0) as ratio
from s group by 1 order by papers desc, category limit 20""")
def sizes_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.sizes_by_category(an.size_rows(papers(spark, sf_dir)), 20)


@query(Q + SIZES + "select sum(pdf_bytes) * (2800000::double / count(*)) as pdf_bytes, sum(text_bytes) * (2800000::double / count(*)) as text_bytes from s")
def extrapolated_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.extrapolate(an.size_rows(papers(spark, sf_dir)))


@query(Q + "select status, count(*) as n, count(*) filter (where low_text) as low_text from papers where bucket between 32 and 159 group by 1")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skein.operators.manifest import slice_predicate

    return an.status_counts(papers(spark, sf_dir).where(slice_predicate((32, 160))))


@query(Q + "select count(*) as papers, count(doi) as with_doi, max(date_updated) as latest, count(distinct shard) filter (where status not in ('done', 'no_pdf')) as open_shards from papers")
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers(spark, sf_dir).agg(F.count("*").alias("papers"), F.count("doi").alias("with_doi"), F.max("date_updated").alias("latest"), F.countDistinct(F.when(~F.col("status").isin("done", "no_pdf"), F.col("shard"))).alias("open_shards"))


@query(Q + "select sum(len(categories)) / count(*)::double as categories_per_paper, sum(length(title)) / greatest(count(*), 1)::double as mean_title, count(*) filter (where n_versions = 1) / count(*)::double as never_revised from papers")
def weighted_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.weighted_means(papers(spark, sf_dir))


@query(Q + """, t as (select (length(title) // 10 * 10)::bigint as chars, count(*) as n from papers group by 1), cut as (select quantile_cont(chars, 0.999) as q from t)
select chars, n, chars - lag(chars) over (order by chars) as step from t, cut where chars <= q""")
def title_length_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = an.counters(papers(spark, sf_dir))["title_length"].withColumnRenamed("count", "n")
    cut = t.agg(F.expr("percentile(chars, 0.999)").alias("q"))
    return t.join(F.broadcast(cut)).where("chars <= q").select("chars", "n", (F.col("chars") - F.lag("chars").over(W.orderBy("chars"))).alias("step"))


@query(Q + "select arxiv_id, date_released from papers where list_contains(categories, 'en') order by date_released desc nulls last, arxiv_id limit 50")
def newest_cross_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers(spark, sf_dir).where(F.array_contains("categories", "en")).orderBy(F.desc_nulls_last("date_released"), "arxiv_id").limit(50).select("arxiv_id", "date_released")


@query(Q + "select arxiv_id, n_tables from papers where n_tables > 0 and list_has_all(categories, ['de', 'en.src3']) order by n_tables desc, arxiv_id")
def most_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers(spark, sf_dir).where((F.col("n_tables") > 0) & text.has_all(F.col("categories"), ["de", "en.src3"])).orderBy(F.desc("n_tables"), "arxiv_id").select("arxiv_id", "n_tables")


@query(Q + r"""select arxiv_id, title from papers where list_has_all(string_split_regex(lower(title), '[^\p{L}\p{N}]+'), ['of', 'the'])""")
def title_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers(spark, sf_dir).where(text.title_matches(F.col("title"), "The of")).select("arxiv_id", "title")


@query(Q + ", y as (select year(date_released) as year, count(*) as n from papers where date_released is not null group by 1) select year::int as year, n from y where year >= (select max(year) from y) - 25")
def recent_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = papers(spark, sf_dir).where("date_released is not null").groupBy(F.year("date_released").alias("year")).agg(F.count("*").alias("n"))
    return y.join(F.broadcast(y.agg(F.max("year").alias("top")))).where("year >= top - 25").select("year", "n")


@query(Q + "select count(*) as papers, count(*) / 1.0 / 3600 as hours, count(*) * 2000000 / 1e9 as pdf_gb, count(*) * 98900 / 1e9 as md_gb from papers where list_has_any(categories, ['en', 'de'])")
def crawl_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = prepare.in_scope(papers(spark, sf_dir), ["en", "de"]).agg(F.count("*").alias("papers"))
    return n.select("papers", (F.col("papers") / 3600).alias("hours"), (F.col("papers") * 2_000_000 / 1e9).alias("pdf_gb"), (F.col("papers") * 98_900 / 1e9).alias("md_gb"))


@query(Q + """select converter, count(*) as papers, sum(n_tables)::bigint as tables, count(*) filter (where n_tables > 0) as with_tables, count(*) filter (where low_text) as thin, arg_max(arxiv_id, n_chars * 10000000 + doc_id) as longest
from papers where converter is not null group by 1""")
def converter_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.compare_converters(papers(spark, sf_dir).where("converter is not null"))
