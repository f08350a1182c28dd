"""Queries of document text: identifiers, lines, tables, equations, pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import ids, markdown, text
from skein.operators import tables as tb
from skein.plans.registry import query
from skein.session import table


@query("""with b as (select doc_id, case when doc_id % 2 = 0 then 'hep-th/' || printf('%02d%02d%03d', 92 + doc_id % 7, 1 + doc_id % 14, doc_id % 1000) else printf('%02d%02d.%05d', 7 + doc_id % 17, 1 + doc_id % 14, doc_id) end as id from documents),
m as (select *, regexp_extract(id, '^(?:[a-zA-Z.-]+/([0-9]{4})[0-9]{3}|([0-9]{4})\\.[0-9]{4,5})$', 1) || regexp_extract(id, '^(?:[a-zA-Z.-]+/([0-9]{4})[0-9]{3}|([0-9]{4})\\.[0-9]{4,5})$', 2) as yymm from b),
s as (select *, case when substr(yymm, 3, 2) between '01' and '12' then yymm else 'misc' end as shard from m)
select doc_id, replace(id, '/', '_') as safe, shard, 'md/' || shard || '/' || replace(id, '/', '_') || '.md' as path from s""")
def identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    old = F.concat(F.lit("hep-th/"), F.format_string("%02d%02d%03d", 92 + i % 7, 1 + i % 14, i % 1000))
    new = F.format_string("%02d%02d.%05d", 7 + i % 17, 1 + i % 14, i)
    d = table(spark, sf_dir, "documents").select("doc_id", F.when(i % 2 == 0, old).otherwise(new).alias("id"))
    return d.select("doc_id", ids.safe_id(F.col("id")).alias("safe"), ids.shard_for(F.col("id")).alias("shard"), ids.object_name("md", F.col("id")).alias("path"))


@query("""select doc_id, case when doc_id % 2 = 0 then 'hep-th/' || printf('%02d%02d%03d', 92 + doc_id % 7, 1 + doc_id % 12, doc_id % 1000) else printf('%02d%02d.%05d', 7 + doc_id % 17, 1 + doc_id % 12, doc_id) end as id from documents""")
def ids_from_object_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects named after papers, found again through both readings of an underscore."""
    i = F.col("doc_id")
    old = F.concat(F.lit("hep-th/"), F.format_string("%02d%02d%03d", 92 + i % 7, 1 + i % 12, i % 1000))
    new = F.format_string("%02d%02d.%05d", 7 + i % 17, 1 + i % 12, i)
    known = table(spark, sf_dir, "documents").select("doc_id", F.when(i % 2 == 0, old).otherwise(new).alias("id"))
    names = known.select(ids.object_name("md", F.col("id"), "store").alias("name"))
    found = names.select(F.explode(ids.id_candidates(F.col("name"), prefix="store")).alias("id")).distinct()
    return known.join(found, "id", "left_semi").select("doc_id", "id")


@query("""select doc_id, trim(regexp_replace(text, '[\\s\\v\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+', ' ', 'g')) as collapsed, (n_chars // 10 * 10)::bigint as bucket, substr(regexp_replace(source || ' ' || lang, '[^A-Za-z0-9._-]', '-', 'g'), 1, 64) as device
from documents""")
def scalar_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", text.collapse_spaces(F.col("text")).alias("collapsed"), text.width_bucket(F.col("n_chars"), 10).alias("bucket"), ids.device_name(F.concat_ws(" ", "source", "lang")).alias("device"))


TABLES = """rows as (select d.doc_id, string_agg('| ' || n.n_nationkey || ' | ' || n.n_name || ' | x |', chr(10) order by n.n_nationkey) as body from documents d join nation n on n.n_regionkey = d.doc_id % 5 group by 1)"""


def _with_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with one table of nations, a caption above, a degenerate table and a line after."""
    n = table(spark, sf_dir, "nation")
    d = table(spark, sf_dir, "documents")
    rows = d.join(F.broadcast(n), F.col("n_regionkey") == F.col("doc_id") % 5).groupBy("doc_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: F.concat(F.lit("| "), x["n_nationkey"], F.lit(" | "), x["n_name"], F.lit(" | x |"))), "\n").alias("rows")
    )
    body = F.concat(F.lit("Head\nTable 1: nations\n| key | name | z |\n| --- | --- | --- |\n"), F.col("rows"), F.lit("\ntail line\n| lone |\n| --- |\n\nend"))
    return rows.select(F.col("doc_id").alias("doc"), body.alias("body"))


@query(f"with {TABLES} select doc_id as doc, 1 as index, (length(body) - length(replace(body, chr(10), '')) + 1)::int as n_rows, 3 as n_cols, 'Table 1: nations' as caption, '| key | name | z |' || chr(10) || '| --- | --- | --- |' || chr(10) || body as markdown from rows")
def lift_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, _ = tb.lift_tables(_with_tables(spark, sf_dir))
    return tables.select("doc", "index", "n_rows", "n_cols", "caption", "markdown")


@query(f"with {TABLES} select doc_id as doc, 'Head' || chr(10) || 'Table 1: nations' || chr(10) || '[[TABLE:1]]' || chr(10) || 'tail line' || chr(10) || chr(10) || 'end' as body from rows")
def bodies_without_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bodies = tb.lift_tables(_with_tables(spark, sf_dir))
    return bodies.select("doc", "body")


@query("""with l as (select doc_id as doc, unnest(string_split(text, chr(10))) as line from documents)
select doc, count(*) filter (where regexp_matches(line, '^\\s*\\|.*\\|\\s*$')) as pipe_lines, count(*) as n_lines from l group by 1""")
def pipe_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), F.col("text").alias("body"))
    return tb.lines(d).groupBy("doc").agg(F.count_if(F.col("line").rlike(markdown.PIPE_LINE)).alias("pipe_lines"), F.count("*").alias("n_lines"))


@query("""with e(pos, line, want) as (values (0, 'a = b + c', true), (1, 'where the value = of all parts', false), (2, '# a = b', false), (3, 'E = mc^2   (1)', true), (4, 'short', false))
select doc_id as doc, string_agg(case when want and not fenced then '$$ ' || line || ' $$' else line end, chr(10) order by pos) as body
from (select doc_id, pos, line, want, false as fenced from documents, e union all select doc_id, 5, '```', false, true from documents union all select doc_id, 6, 'x = y + z', true, true from documents) group by 1""")
def mark_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = ["a = b + c", "where the value = of all parts", "# a = b", "E = mc^2   (1)", "short", "```", "x = y + z"]
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), F.lit("\n".join(lines)).alias("body"))
    return tb.mark_equations(d)


@query("""with c as (select conv_id, turn, case when turn % 3 = 1 then conv_id || ' converted by fallback fast' || turn || ' after: time' else text end as line from conversations)
select conv_id, regexp_extract(arg_max(line, turn), 'converted by fallback (\\S+) after', 1) as converter from c where turn % 3 = 1 group by 1""")
def fallback_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    line = F.when(F.col("turn") % 3 == 1, F.concat(F.col("conv_id"), F.lit(" converted by fallback fast"), F.col("turn"), F.lit(" after: time"))).otherwise(F.col("text"))
    f = c.select("conv_id", "turn", text.fallback_in_line(line).alias("f")).where("f.id is not null")
    return f.groupBy("conv_id").agg(F.max_by("f.converter", "turn").alias("converter"))


@query("select page_id, sha256(html) as digest, octet_length(encode(html)) as bytes, contains(lower(html[1:2048]), 'access denied') as blocked from pages")
def page_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    raw = F.encode("html", "UTF-8")
    return p.select("page_id", F.sha2(raw, 256).alias("digest"), F.length(raw).cast("long").alias("bytes"), text.looks_blocked(raw).alias("blocked"))


@query("""with t as (select n_regionkey as r, '<table>' || string_agg('<tr><td>' || n_nationkey || '</td><td>' || n_name || ' &amp; co</td></tr>', '' order by n_nationkey) || '</table>' as html,
 string_agg('| ' || n_nationkey || ' | ' || n_name || ' & co |', chr(10) order by n_nationkey) as rows from nation group by 1)
select page_id, chr(10) || chr(10) || string_split(rows, chr(10))[1] || chr(10) || '| --- | --- |' || chr(10) || array_to_string(string_split(rows, chr(10))[2:], chr(10)) || chr(10) || chr(10) as markdown from pages join t on page_id % 5 = r""")
def html_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = F.transform(F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: F.concat(F.lit("<tr><td>"), x["n_nationkey"], F.lit("</td><td>"), x["n_name"], F.lit(" &amp; co</td></tr>")))
    t = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.concat(F.lit("<table>"), F.array_join(cells, ""), F.lit("</table>")).alias("html"))
    p = table(spark, sf_dir, "pages").select("page_id")
    return p.join(F.broadcast(t), F.col("page_id") % 5 == F.col("n_regionkey")).select("page_id", markdown.html_tables_to_pipe(F.col("html")).alias("markdown"))


@query("""select doc_id, n_chars / (doc_id % 30) < 100 as low_text from documents where doc_id % 30 > 0 union all select doc_id, false from documents where doc_id % 30 = 0""")
def low_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", tb.low_text((F.col("doc_id") % 30).cast("int"), F.col("n_chars")).alias("low_text"))
