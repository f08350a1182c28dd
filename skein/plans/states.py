"""Queries of the manifest: folding, claims, updates, observations, plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skein.functions import ids
from skein.operators import analytics as an
from skein.operators import manifest as mf
from skein.operators import partition as pt
from skein.operators import sinks
from skein.plans.derived import EVENTS, PAPERS, SIGHTINGS, papers, results, sightings
from skein.plans.registry import query
from skein.session import table

Q = f"with {PAPERS}\n"
S = f"with {PAPERS}, {SIGHTINGS}\n"
FOLD = f"""with {EVENTS}, p as (select *, not (upgrade and status <> 'done') as plain from results),
folded as (select paper, arg_max(status, seq) filter (where plain) as status, case when arg_max(status, seq) filter (where plain) in ('done', 'no_pdf') then max(ts) filter (where plain) end as completed_at,
  arg_max(struct_pack(e := error), seq) filter (where plain) as err, arg_max(pdf_bytes, seq) filter (where plain and pdf_bytes is not null) as pdf_bytes, arg_max(md_bytes, seq) filter (where plain and md_bytes is not null) as md_bytes,
  count(*) filter (where plain and count_attempt) as attempts, count(*) filter (where not plain) as upgrade_attempts from p group by paper)
"""


@query(FOLD + "select paper, status, completed_at, err.e as error, pdf_bytes, md_bytes, attempts, upgrade_attempts from folded")
def fold_task_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mf.fold_events(results(spark, sf_dir), columns=("pdf_bytes", "md_bytes"))


@query(f"with {EVENTS} select paper, arg_max(status, seq) as status from results group by 1")
def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mf.latest_by_key(results(spark, sf_dir), "paper", "status", "seq")


@query(f"with {EVENTS} select count(*) as processed, count(*) filter (where status = 'done') as done, count(*) filter (where status = 'no_pdf') as no_pdf, count(*) filter (where status like 'failed%') as failed, count(*) filter (where seq % 3 > 1) as retried, count(*) filter (where seq % 5 = 0) as fell_back, count(*) filter (where upgrade and status = 'done') as upgraded from results")
def run_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.run_tallies(results(spark, sf_dir).withColumn("attempt", F.col("seq") % 3).withColumn("fell_back", F.col("seq") % 5 == 0))


@query(f"""with {EVENTS}, i as (select paper, seq, status = 'pending' as bad, sum(case when status = 'pending' then 0 else 1 end) over (partition by paper order by seq) as island from results),
r as (select *, sum(case when bad then 1 else 0 end) over (partition by paper, island order by seq)::bigint as run from i)
select paper, seq, run, run >= 4 as alarm, case when bad then least(3600 * pow(2, run - 1), 21600)::bigint end as pause from r""")
def runs_and_cooldowns(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = results(spark, sf_dir).withColumn("bad", F.col("status") == "pending")
    return an.cooldown_ladder(r, "paper", "seq", "bad").select("paper", "seq", "run", (F.col("run") >= 4).alias("alarm"), "pause")


@query(f"""with {EVENTS}, m as (select paper, error, count(*) as n, min(seq) as first from results where error is not null group by 1, 2)
select paper, string_agg(error || case when n > 1 then ' (x' || n || ')' else '' end, '; ' order by first) as errors from m group by 1""")
def repeated_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.repeated_errors(results(spark, sf_dir).where("error is not null"), "paper", "seq", "error")


@query(Q + "select arxiv_id, attempts from papers where status in ('pending', 'outdated') and attempts < 4 and bucket between 0 and 127 order by arxiv_id limit 20")
def claim_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mf.claim(papers(spark, sf_dir), 20, max_attempts=4, part=(0, 128)).select("arxiv_id", "attempts")


@query(Q + ", c as (select arxiv_id from papers where status in ('pending', 'outdated') order by arxiv_id limit 20) select status, count(*) as n from (select case when arxiv_id in (select arxiv_id from c) then 'in_flight' else status end as status from papers) group by 1")
def status_after_claim(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = papers(spark, sf_dir)
    return mf.set_status(p, mf.claim(p, 20), "in_flight").groupBy("status").agg(F.count("*").alias("n"))


@query(Q + "select arxiv_id, case when status = 'in_flight' or (status = 'failed_download' and attempts < 3) then 'pending' else status end as status from papers")
def resets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mf.reset_failed(mf.reset_stale(papers(spark, sf_dir)), "download", ceiling=3).select("arxiv_id", "status")


INCOMING = """, inc as (select distinct on (arxiv_id) * from (select printf('%02d%02d.%05d', 7 + doc_id % 17, 1 + doc_id % 14, doc_id) as arxiv_id, 'v' || (1 + doc_id % 4) as version, date '2020-01-01' + (doc_id % 90)::int as date_updated from labels
  union all select 'new/' || doc_id, 'v1', date '2020-01-01' from labels where doc_id % 10 = 0))"""


def _incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    rows = table(spark, sf_dir, "labels")
    day = F.lit("2020-01-01").cast("date")
    known = rows.select(F.format_string("%02d%02d.%05d", 7 + i % 17, 1 + i % 14, i).alias("arxiv_id"), F.concat(F.lit("v"), 1 + i % 4).alias("version"), F.date_add(day, (i % 90).cast("int")).alias("date_updated"))
    return known.unionByName(rows.where(i % 10 == 0).select(F.concat(F.lit("new/"), i).alias("arxiv_id"), F.lit("v1").alias("version"), day.alias("date_updated")))


@query(Q + INCOMING + """select i.arxiv_id, i.version, case when p.arxiv_id is null then 'insert' when substr(i.version, 2)::int > substr(p.version, 2)::int and p.status <> 'in_flight' then 'bump' else 'unchanged' end as change
from inc i left join papers p using (arxiv_id)""")
def classify_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mf.classify_updates(papers(spark, sf_dir), _incoming(spark, sf_dir)).select("arxiv_id", "version", "change")


@query(Q + INCOMING + """, b as (select i.* from inc i join papers p using (arxiv_id) where substr(i.version, 2)::int > substr(p.version, 2)::int and p.status <> 'in_flight')
select p.arxiv_id, coalesce(b.version, p.version) as version, case when b.arxiv_id is not null and p.status = 'done' then 'outdated' else p.status end as status,
case when b.arxiv_id is not null and p.status = 'done' then 0 else p.attempts end as attempts from papers p left join b using (arxiv_id)""")
def apply_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mf.apply_updates(papers(spark, sf_dir), _incoming(spark, sf_dir)).select("arxiv_id", "version", "status", "attempts")


@query(Q + INCOMING + "select arxiv_id, version from inc where arxiv_id not in (select arxiv_id from papers)")
def insert_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mf.insert_new(papers(spark, sf_dir), _incoming(spark, sf_dir)).select("arxiv_id", "version")


GUARD = "(p.status <> 'outdated' or coalesce(s.last_modified::varchar, '') >= p.date_updated::varchar)"


@query(S + f"""select count(p.arxiv_id) as matched, count(*) filter (where p.status = 'done') as already_done, count(*) filter (where p.status = 'in_flight') as in_flight_skipped,
count(*) filter (where p.status not in ('done', 'in_flight')) as newly_marked_dry, count(*) filter (where p.status not in ('done', 'in_flight') and {GUARD}) as newly_marked, count(*) filter (where p.status = 'no_pdf') as no_pdf_recovered,
count(*) filter (where p.arxiv_id is null) as absent from (select arxiv_id, max(last_modified) as last_modified from sightings where has_meta = 1 group by 1) s left join papers p using (arxiv_id)""")
def observation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mf.observation_report(papers(spark, sf_dir), sightings(spark, sf_dir).where("has_meta = 1"))


@query(S + f"""select p.arxiv_id, case when h then 'done' else p.status end as status, case when h then coalesce(p.md_bytes, s.size) else p.md_bytes end as md_bytes, p.remote_only or h as remote_only
from (select p.*, s.size, coalesce(s.arxiv_id is not null and p.status not in ('done', 'in_flight') and {GUARD}, false) as h, s from papers p left join sightings s using (arxiv_id)) p""".replace("s.size, coalesce", "s.size as seen, coalesce").replace("coalesce(p.md_bytes, s.size)", "coalesce(p.md_bytes, p.seen)").replace(" as h, s from", " as h from"))
def mark_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mf.mark_done(papers(spark, sf_dir), sightings(spark, sf_dir)).select("arxiv_id", "status", "md_bytes", "remote_only")


@query(S + "select has_meta = 1 as has_meta, count(*) as n, count(*) filter (where arxiv_id in (select arxiv_id from papers)) as known from sightings group by 1")
def stored_with_and_without_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = papers(spark, sf_dir).select("arxiv_id", F.lit(1).alias("k"))
    return sightings(spark, sf_dir).join(known, "arxiv_id", "left").groupBy((F.col("has_meta") == 1).alias("has_meta")).agg(F.count("*").alias("n"), F.count("k").alias("known"))


@query(Q + "select arxiv_id from papers where status = 'done' and converter = 'fast' and upgrade_attempts < 2")
def upgrade_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mf.upgrade_candidates(papers(spark, sf_dir), "fast", 2).select("arxiv_id")


@query(Q + "select arxiv_id, case when status = 'done' then coalesce(converter, 'found') else converter end as converter from papers")
def record_converters(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = papers(spark, sf_dir)
    return mf.record_converters(p, p.select("arxiv_id", F.lit("found").alias("converter"))).select("arxiv_id", "converter")


@query(Q + """, q as (select arxiv_id, 1 as priority from papers where status = 'failed_download' and attempts < 4 and bucket < 128
 union all select arxiv_id, 2 from papers where status = 'done' and converter = 'fast' union all select arxiv_id, 3 from papers where status in ('pending', 'outdated') and attempts < 4 and bucket < 128
 union all select arxiv_id, 0 from papers where status = 'failed_download' and doc_id % 5 = 1 union all select arxiv_id, 4 from papers where status in ('pending', 'outdated', 'failed_download') and attempts < 4 and bucket >= 128)
select arxiv_id, min(priority)::int as priority from q group by 1""")
def work_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = papers(spark, sf_dir)
    return mf.work_order(p, p.where("doc_id % 5 = 1"), mf.upgrade_candidates(p, "fast"), (0, 128), 4)


@query(Q + """, due as (select arxiv_id, unnest(['md', 'meta']) as kind from papers where status = 'done' and not remote_only union all select arxiv_id, 'tables' from papers where status = 'done' and not remote_only and n_tables > 0)
select d.arxiv_id, d.kind from due d join papers p using (arxiv_id) where not (p.doc_id % 4 <> 0 and d.kind = 'md')""")
def verify_artefacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = papers(spark, sf_dir)
    stored = p.where("doc_id % 4 <> 0").select(ids.object_name("md", F.col("arxiv_id")).alias("name"))
    return mf.missing_artefacts(p, stored).select("arxiv_id", "kind")


PLAN = "plan(device, lo, hi) as (values ('a', 0, 100), ('b', 100, 130), ('c', 120, 200))"


def _plan(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("a", 0, 100), ("b", 100, 130), ("c", 120, 200)], "device string, lo int, hi int")


@query(f"with {PLAN}, {PAPERS} select p.arxiv_id, p.bucket, plan.device from papers p left join plan on p.bucket >= lo and p.bucket < hi")
def bucket_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pt.owners(papers(spark, sf_dir).select("arxiv_id", "bucket"), _plan(spark))


@query(f"with {PLAN} select a.device as device_a, b.device as device_b from plan a join plan b on a.lo < b.hi and b.lo < a.hi and a.device < b.device")
def plan_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pt.overlaps(_plan(spark))


@query(f"with {PLAN} select 256 - count(distinct b) as unassigned from (select unnest(range(lo, hi)) as b from plan)")
def plan_unassigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pt.unassigned(_plan(spark))


@query("""with w as (select n_nationkey as ord, n_name as name, (1 + n_nationkey % 4)::double as weight from nation), s as (select *, weight * 256 / sum(weight) over () as share from w),
z as (select *, floor(share) as size, 256 - sum(floor(share)) over () as spare, row_number() over (order by share - floor(share) desc, ord) as place from s),
f as (select ord, name, size + case when place <= spare then 1 else 0 end as size from z)
select name, (sum(size) over (order by ord) - size)::int as lo, (sum(size) over (order by ord))::int as hi from f""")
def weighted_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("ord"), F.col("n_name").alias("name"), (1 + F.col("n_nationkey") % 4).cast("double").alias("weight"))
    return pt.weighted_ranges(n)


@query("""with m as (select user_id % 5 as device, event_id % 3 as lo, ts, event_type as state from events), l as (select device, arg_max(lo, ts) as lo, arg_max(state, ts) as state, max(ts) as ts from m group by 1), now as (select max(ts) as t from events)
select d::bigint as device, case when l.device is null then 'missing' when l.ts < now.t - interval 1 hour then 'stale' when l.lo <> 1 then 'mismatch' else 'ok' end as verdict from (select unnest(range(7)) as d), now left join l on l.device = d""")
def plan_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    markers = e.select((F.col("user_id") % 5).alias("device"), (F.col("event_id") % 3).alias("lo"), F.lit(9).alias("hi"), F.col("event_type").alias("state"), F.col("ts").alias("updated_at"))
    plan = spark.range(7).select(F.col("id").alias("device"), F.lit(1).alias("lo"), F.lit(9).alias("hi"))
    now = e.agg(F.max("ts").alias("t")).first().t
    return pt.agreement(plan, markers, F.lit(now).cast("timestamp_ntz"), 1).select("device", "verdict")


@query(Q + "select 'd1' as device, count(*) as n from papers where status = 'done' and not remote_only")
def journal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = mf.journal_ids(papers(spark, sf_dir).where("not remote_only"))
    return sinks.journal_segments(done, "d1", size=100).groupBy("device").agg(F.count("*").alias("n"))


@query(S + ", r as (select arxiv_id as name, size from sightings) select case when p.arxiv_id is null then 'moved' else 'skipped' end as outcome, count(*) as n, sum(size)::bigint as bytes from r left join papers p on p.arxiv_id = r.name group by 1")
def move_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    local = sightings(spark, sf_dir).select(F.col("arxiv_id").alias("name"), "size")
    return sinks.move_report(sinks.move_plan(local, papers(spark, sf_dir).select(F.col("arxiv_id").alias("name"))))


@query("""with v as (select o_custkey as paper, o_orderkey, o_orderdate, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as n from orders)
select paper, 'v' || max(n) as latest, min(o_orderdate)::date as first_date, arg_max(o_orderdate, n)::date as latest_date, count(*)::int as n from v group by 1""")
def resolve_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skein.operators.prepare import resolve_versions as resolve

    o = table(spark, sf_dir, "orders").withColumn("n", F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")))
    stamp = F.date_format("o_orderdate", "EEE, d MMM yyyy HH:mm:ss")
    v = o.groupBy(F.col("o_custkey").alias("paper")).agg(F.collect_list(F.struct(F.concat(F.lit("v"), "n").alias("version"), F.concat(stamp, F.lit(" GMT")).alias("created"))).alias("versions"))
    r = v.select("paper", resolve(F.col("versions")).alias("r"))
    return r.select("paper", "r.latest", "r.first_date", "r.latest_date", "r.n")


@query("""with w as (select user_id % 4 as slot, count(*) as processed, count(*) filter (where event_type = 'purchase') as done, count(*) filter (where event_type = 'error') as failed from events group by 1)
select sum(processed)::bigint as processed, sum(done)::bigint as done, sum(failed)::bigint as failed, round_even(sum(done) / 600.0::double * 60, 2) as per_minute from w""")
def worker_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy((F.col("user_id") % 4).alias("slot"))
    workers = e.agg(F.count("*").alias("processed"), F.count_if(F.col("event_type") == "purchase").alias("done"), F.count_if(F.col("event_type") == "error").alias("failed"))
    return an.progress(workers, 600.0)
