"""Queries of upkeep: upgrades, devices, checkpoints, samples, front matter, whole texts and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import markdown, text
from skein.operators import analytics as an
from skein.operators import manifest as mf
from skein.operators import partition as pt
from skein.operators import tables as tb
from skein.plans.derived import EVENTS, PAPERS, papers, results
from skein.plans.registry import query
from skein.session import table

Q = f"with {PAPERS}\n"


@query(Q + "select arxiv_id, attempts from papers where arxiv_id in (select printf('%02d%02d.%05d', 7 + doc_id % 17, 1 + doc_id % 14, doc_id) from labels) and status = 'done' and converter = 'fast'")
def upgrade_recheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    asked = table(spark, sf_dir, "labels").select(F.format_string("%02d%02d.%05d", 7 + i % 17, 1 + i % 14, i).alias("arxiv_id"))
    return mf.rows_for_upgrade(papers(spark, sf_dir), asked, "fast").select("arxiv_id", "attempts")


@query(Q + "select arxiv_id from papers where status = 'done' and converter is null and n_chars is not null")
def unknown_converter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mf.unknown_converters(papers(spark, sf_dir))


@query(Q + """, asked as (select printf('%02d%02d.%05d', 7 + doc_id % 17, 1 + doc_id % 15, doc_id) as arxiv_id, case when quality = 1 then 'v9' end as version from labels)
select a.arxiv_id, coalesce(a.version, p.version, 'v1') as version, coalesce(p.title, a.arxiv_id) as title, coalesce(p.attempts, 0) as attempts, p.arxiv_id is not null as known, coalesce(len(p.categories), 0)::int as n_categories
from asked a left join papers p using (arxiv_id)""")
def paper_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    asked = table(spark, sf_dir, "labels").select(F.format_string("%02d%02d.%05d", 7 + i % 17, 1 + i % 15, i).alias("arxiv_id"), F.when(F.col("quality") == 1, "v9").alias("version"))
    found = mf.paper_row(papers(spark, sf_dir), asked)
    return found.select("arxiv_id", "version", "title", "attempts", "known", F.size("categories").alias("n_categories"))


@query("""with seen as (select distinct 'd' || user_id as device from events where event_type <> 'error' union select 'me'),
dropped as (select 'd' || s_suppkey as device from supplier where s_suppkey % 3 = 0) select device from seen where device not in (select device from dropped)""")
def equal_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Devices that share equally: those with a marker and this one, less the dropped."""
    markers = table(spark, sf_dir, "events").select(F.when(F.col("event_type") != "error", F.concat(F.lit("d"), "user_id")).alias("device"))
    dropped = table(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0").select(F.concat(F.lit("d"), "s_suppkey").alias("device"))
    return pt.reporting(markers, "me", dropped)


@query(Q + "select distinct shard from papers where status <> 'done' and shard not in (select shard from papers group by 1 having count(*) filter (where status = 'pending') > 1)")
def shards_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards with unfinished papers that an earlier scan, of those with several pending ones, hasn't read."""
    p = papers(spark, sf_dir)
    finished = p.groupBy("shard").agg(F.count_if(F.col("status") == "pending").alias("n")).where("n > 1")
    return pt.remaining(p.where("status <> 'done'"), finished)


@query(f"""with {EVENTS} select (paper % 8)::int as slot, count(*) as processed, count(*) filter (where status = 'done') as done, count(*) filter (where status = 'failed_convert') as failed, count(*) filter (where status = 'no_pdf') as no_pdf,
 arg_max(paper, seq) as last_paper, max(ts) as updated_at from results where status in ('done', 'failed_convert', 'no_pdf') group by 1""")
def worker_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.worker_states(results(spark, sf_dir).withColumn("slot", (F.col("paper") % 8).cast("int")))


@query(f"with {EVENTS} select seq, error from results where error is not null order by seq limit 20")
def first_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.error_sample(results(spark, sf_dir), "seq", "error")


@query("""with m as (select o_orderpriority as key, date_trunc('month', o_orderdate) as month, count(*) as n from orders group by 1, 2), s as (select key, n - lag(n) over (partition by key order by month) as step from m)
select key, median(step)::double as step from s group by 1""")
def median_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("key"), F.trunc("o_orderdate", "month").alias("month")).agg(F.count("*").alias("n"))
    return an.median_step(m, "key", "month", "n")


_SCALAR = """case when regexp_matches({0}, '^[A-Za-z][A-Za-z0-9_]*([ .,/-]+[A-Za-z0-9_]+)*$') and lower({0}) not in ('true', 'false', 'null', 'yes', 'no', 'on', 'off', 'y', 'n') then {0}
 else '"' || replace(replace(replace(replace(replace({0}, chr(92), chr(92) || chr(92)), '"', chr(92) || '"'), chr(10), chr(92) || 'n'), chr(9), chr(92) || 't'), chr(13), chr(92) || 'r') || '"' end"""


@query(
    Q
    + f"""select arxiv_id, '---' || chr(10) || 'arxiv_id: ' || {_SCALAR.format("arxiv_id")} || chr(10) || case when title <> '' then 'title: ' || {_SCALAR.format("title")} || chr(10) else '' end
 || coalesce('doi: ' || {_SCALAR.format("doi")} || chr(10), '') || coalesce('converter: ' || {_SCALAR.format("converter")} || chr(10), '') || 'n_pages: ' || n_pages || chr(10) || coalesce('pdf_bytes: ' || pdf_bytes || chr(10), '')
 || 'categories:' || chr(10) || list_aggregate(list_transform(categories, lambda c: '- ' || {_SCALAR.format("c")} || chr(10)), 'string_agg', '') || '---' || chr(10) || chr(10) as head from papers"""
)
def front_matter_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    head = text.front_matter({k: c(k) for k in ("arxiv_id", "title", "doi", "converter")}, {k: c(k) for k in ("n_pages", "pdf_bytes")}, {"categories": c("categories")})
    return papers(spark, sf_dir).select("arxiv_id", head.alias("head"))


#: DuckDB's word boundary knows ASCII only, so letters beyond it become word signs first.
_EQUATION = """length(trim(line)) between 3 and 200 and not regexp_matches(trim(line), '^[-*#>|]|^```') and length(core) >= 6 and regexp_matches(core, '[=≠≡≤≥≈∝±∓·×∑∏∫√∂∇←→↦⊕⊗⊙∈∉⊂⊆∃∀]')
 and not regexp_matches(regexp_replace(core, '[À-ÖØ-öø-ɏ]', '_', 'g'), '\\b[a-zA-Z]{3,}\\b[, ]+\\b[a-zA-Z]{3,}\\b[, ]+\\b[a-zA-Z]{3,}\\b') and (regexp_matches(core, '[(]\\s*[0-9]+\\s*[)]\\s*$') or not regexp_matches(core, '[.:;?]$'))
 and length(regexp_replace(core, '[^\\p{L}]', '', 'g')) < 0.75 * length(core) and len(string_split_regex(core, '\\s+')) <= 25"""


@query(f"""with d as (select doc_id as doc, text || chr(10) || 'x_' || doc_id || ' = a + ' || n_chars || '   (' || doc_id || ')' || chr(10) || 'y = ' || substr(text, 1, 40) as body from documents),
l as (select doc, unnest(string_split(body, chr(10))) as line, generate_subscripts(string_split(body, chr(10)), 1) as pos from d),
f as (select *, starts_with(trim(line), '```') as fence, trim(regexp_replace(trim(line), '[\\[\\]`~*_]+', '', 'g')) as core from l),
w as (select *, sum(fence::int) over (partition by doc order by pos) % 2 = 1 as inside from f)
select doc, string_agg(case when not inside and not fence and ({_EQUATION}) then '$$ ' || trim(line) || ' $$' else line end, chr(10) order by pos) as body from w group by 1""")
def equations_in_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with a numbered equation and a line that may read like one behind them."""
    i = F.col("doc_id")
    tail = F.concat(F.lit("\nx_"), i, F.lit(" = a + "), "n_chars", F.lit("   ("), i, F.lit(")\ny = "), F.substring("text", 1, 40))
    return tb.mark_equations(table(spark, sf_dir, "documents").select(i.alias("doc"), F.concat("text", tail).alias("body")))


@query("""select page_id, html || chr(10) || chr(10) || '| key | ' || page_id || ' |' || chr(10) || '| --- | --- |' || chr(10) || '| size | ' || length(html) || ' |' || chr(10) || chr(10) as markdown from pages""")
def html_tables_in_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole pages (which hold no table of their own) with one behind them."""
    p = table(spark, sf_dir, "pages")
    body = F.concat("html", F.lit("<TABLE border=1><tr><th>key</th><td>"), "page_id", F.lit("</td></tr>\n<tr ><td>size</td><td> <b>"), F.length("html"), F.lit("</b>\n</td></tr></TABLE>"))
    return p.select("page_id", markdown.html_tables_to_pipe(body).alias("markdown"))


@query("""select n_nationkey as key, [[n_name, 'Ada', ''], [split_part(r_name, ' ', len(string_split(r_name, ' '))), trim(substr(r_name, 1, length(r_name) - length(split_part(r_name, ' ', len(string_split(r_name, ' ')))))) , 'Jr']] as authors
from nation join region on n_regionkey = r_regionkey""")
def author_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Author lists with affiliations nested as deep as the nation's key."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    j = n.join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))
    nested = F.concat(F.repeat(F.lit("("), F.col("n_nationkey")), F.lit("x"), F.repeat(F.lit(")"), F.col("n_nationkey")))
    raw = F.concat(F.lit("Ada "), F.when(F.col("n_nationkey") > 0, nested).otherwise(""), F.lit(" "), "n_name", F.lit(", and "), "r_name", F.lit(" Jr"))
    return j.select(F.col("n_nationkey").alias("key"), text.split_authors(raw).alias("authors"))
