"""The status manifest: inserts, events folded to a snapshot, claims, resets, updates and observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skein.functions import ids

STATUSES = ("pending", "in_flight", "done", "no_pdf", "failed_download", "failed_convert", "outdated")
RETRYABLE = ("failed_download", "failed_convert")
FRESH = ("pending", "outdated")
CLAIM_COLUMNS = tuple("arxiv_id version shard title authors categories primary_category doi date_released date_updated attempts".split())
FOLDED = ("pdf_bytes", "md_bytes", "tables_bytes", "n_pages", "n_tables", "n_chars", "converter")


def insert_new(manifest: DataFrame, rows: DataFrame, key: str = "arxiv_id") -> DataFrame:
    """Rows not in the manifest, one for each key (insert or ignore)."""
    return rows.join(manifest.select(key), key, "left_anti").dropDuplicates([key])


def latest_by_key(log: DataFrame, key: str, value: str, seq: str) -> DataFrame:
    """Upserted key/value pairs: the last write of each key."""
    return log.groupBy(key).agg(F.max_by(value, seq).alias(value))


def fold_events(events: DataFrame, key: str = "paper", seq: str = "seq", columns: tuple[str, ...] = FOLDED) -> DataFrame:
    """One row for each paper from its task results: last status, last non-null of each column, counted attempts.

    completed_at is the time of the last event if that is done or no_pdf, else null. A failed
    upgrade (upgrade true, status not done) only adds to upgrade_attempts. Aggregations with
    map-side maxima, no sort: a hot paper costs one row per partition.
    """
    plain = ~(F.coalesce("upgrade", F.lit(False)) & (F.col("status") != "done"))
    last = F.max_by(F.struct("status", "ts", "error"), F.when(plain, F.col(seq)))
    folded = events.groupBy(key).agg(
        last.alias("last"), *(F.max_by(c, F.when(plain & F.col(c).isNotNull(), F.col(seq))).alias(c) for c in columns),
        F.sum(F.when(F.col("count_attempt") & plain, 1).otherwise(0)).alias("attempts"), F.sum(F.when(plain, 0).otherwise(1)).alias("upgrade_attempts"),
    )
    done = F.col("last.status").isin("done", "no_pdf")
    return folded.select(key, F.col("last.status").alias("status"), F.when(done, F.col("last.ts")).alias("completed_at"), F.col("last.error").alias("error"), *columns, "attempts", "upgrade_attempts")


def apply_results(manifest: DataFrame, folded: DataFrame, key: str = "arxiv_id", columns: tuple[str, ...] = FOLDED) -> DataFrame:
    """A batch of folded results over a snapshot; new nulls keep old values."""
    f = folded.select(F.col(folded.columns[0]).alias("_k"), *(F.col(c).alias("_" + c) for c in folded.columns[1:]))
    j = manifest.join(f, manifest[key] == f["_k"], "left")
    hit = F.col("_status").isNotNull()
    new = {c: F.coalesce("_" + c, c) for c in columns}
    new |= {"status": F.coalesce("_status", "status"), "error": F.when(hit, F.col("_error")).otherwise(F.col("error")), "completed_at": F.when(hit, F.col("_completed_at")).otherwise(F.col("completed_at"))}
    new |= {c: F.col(c) + F.coalesce("_" + c, F.lit(0)) for c in ("attempts", "upgrade_attempts")}
    return j.select(*(new[c].alias(c) if c in new else F.col(c) for c in manifest.columns))


def slice_predicate(part: tuple[int, int] | None, bucket: str = "bucket") -> Column:
    """None is the whole corpus; an empty slice is nothing."""
    if part is None:
        return F.lit(True)
    lo, hi = part
    return F.col(bucket).between(lo, hi - 1) if lo < hi else F.lit(False)


def claimable(manifest: DataFrame, statuses: tuple[str, ...] = FRESH, max_attempts: int | None = None, part: tuple[int, int] | None = None) -> DataFrame:
    rows = manifest.where(F.col("status").isin(*statuses)).where(slice_predicate(part))
    return rows if max_attempts is None else rows.where(F.col("attempts") < max_attempts)


def claim(manifest: DataFrame, n: int, *, part: tuple[int, int] | None = None, max_attempts: int | None = None, statuses: tuple[str, ...] = FRESH) -> DataFrame:
    """The first n claimable rows by id; the planner appends in_flight events for them."""
    return claimable(manifest, statuses, max_attempts, part).orderBy("arxiv_id").limit(n)


def claim_ids(manifest: DataFrame, wanted: DataFrame, *, among: tuple[str, ...] = RETRYABLE) -> DataFrame:
    """Of a saved worklist the rows whose status hasn't moved on."""
    return manifest.where(F.col("status").isin(*among)).join(wanted.select("arxiv_id").distinct(), "arxiv_id", "left_semi")


def set_status(manifest: DataFrame, chosen: DataFrame, status: str) -> DataFrame:
    hit = chosen.select(F.col("arxiv_id").alias("_k"), F.lit(status).alias("_s")).distinct()
    return manifest.join(hit, manifest["arxiv_id"] == hit["_k"], "left").withColumn("status", F.coalesce("_s", "status")).select(*manifest.columns)


def reset_stale(manifest: DataFrame) -> DataFrame:
    return manifest.withColumn("status", F.when(F.col("status") == "in_flight", "pending").otherwise(F.col("status")))


def reset_failed(manifest: DataFrame, stage: str = "", ceiling: int = 4) -> DataFrame:
    """Failures of a stage (download, convert, or both) below the ceiling are pending again, their error cleared."""
    which = (f"failed_{stage}",) if stage else RETRYABLE
    hit = F.col("status").isin(*which) & (F.col("attempts") < ceiling)
    return manifest.withColumn("error", F.when(~hit, F.col("error"))).withColumn("status", F.when(hit, "pending").otherwise(F.col("status")))


def classify_updates(manifest: DataFrame, incoming: DataFrame) -> DataFrame:
    """incoming with change = insert, bump or unchanged: newer versions bump unless the paper is in flight."""
    have = manifest.select(F.col("arxiv_id").alias("_k"), F.col("version").alias("_v"), F.col("status").alias("_s"))
    newer = ids.version_number(F.col("version")) > ids.version_number(F.col("_v"))
    kind = F.when(F.col("_k").isNull(), "insert").when(newer & (F.col("_s") != "in_flight"), "bump").otherwise("unchanged")
    return incoming.join(have, incoming["arxiv_id"] == have["_k"], "left").withColumn("change", kind).withColumn("old_status", F.col("_s")).drop("_k", "_v", "_s")


def apply_updates(manifest: DataFrame, incoming: DataFrame, recrawl: bool = True) -> DataFrame:
    """Bumped rows take the new version; done ones become outdated (if recrawl) with attempts at zero."""
    bumps = classify_updates(manifest, incoming.dropDuplicates(["arxiv_id"])).where("change = 'bump'").select(F.col("arxiv_id").alias("_k"), F.col("version").alias("_v"), F.col("date_updated").alias("_d"))
    j = manifest.join(bumps, manifest["arxiv_id"] == bumps["_k"], "left")
    hit = F.col("_k").isNotNull()
    stale = hit & (F.col("status") == "done") & F.lit(recrawl)
    new = {"version": F.coalesce("_v", "version"), "date_updated": F.coalesce("_d", "date_updated"), "status": F.when(stale, "outdated").otherwise(F.col("status")), "attempts": F.when(stale, 0).otherwise(F.col("attempts"))}
    return j.select(*(new[c].alias(c) if c in new else F.col(c) for c in manifest.columns))


def up_to_date(status: Column, object_time: Column, date_updated: Column) -> Column:
    """An outdated paper is done only by an object no older than its last update; a missing object date is stale."""
    stamp = F.coalesce(F.substring(object_time.cast("string"), 1, 10), F.lit(""))
    return (status != "outdated") | (stamp >= F.coalesce(date_updated.cast("string"), F.lit("9999-12-31")))


def mark_done(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """Papers seen in the store become done, except in-flight ones and outdated ones with an old object.

    found has arxiv_id, size and last_modified; of several sightings the newest counts.
    """
    seen = found.groupBy(F.col("arxiv_id").alias("_k")).agg(F.max(F.struct("last_modified", "size")).alias("_o"))
    j = manifest.join(seen, manifest["arxiv_id"] == seen["_k"], "left")
    hit = F.coalesce(F.col("_k").isNotNull() & ~F.col("status").isin("done", "in_flight") & up_to_date(F.col("status"), F.col("_o.last_modified"), F.col("date_updated")), F.lit(False))
    new = {
        "status": F.when(hit, "done").otherwise(F.col("status")), "md_bytes": F.when(hit, F.coalesce("md_bytes", F.col("_o.size"))).otherwise(F.col("md_bytes")),
        "completed_at": F.when(hit, F.coalesce(F.col("completed_at"), F.col("_o.last_modified").cast("timestamp_ntz"))).otherwise(F.col("completed_at")), "remote_only": F.col("remote_only") | hit,
    }
    return j.select(*(new[c].alias(c) if c in new else F.col(c) for c in manifest.columns))


def observation_report(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """One row of counters over papers and sightings.

    newly_marked_dry is matched minus done minus in flight; newly_marked also heeds the guard for outdated papers.
    """
    seen = found.groupBy("arxiv_id").agg(F.max("last_modified").alias("last_modified"))
    m = manifest.select(F.col("arxiv_id").alias("_k"), "status", "date_updated")
    j = seen.join(m, seen["arxiv_id"] == m["_k"], "left")
    matched, status = F.col("_k").isNotNull(), F.col("status")
    moved = matched & ~status.isin("done", "in_flight")
    return j.agg(
        F.count_if(matched).alias("matched"), F.count_if(status == "done").alias("already_done"), F.count_if(status == "in_flight").alias("in_flight_skipped"),
        F.count_if(moved).alias("newly_marked_dry"), F.count_if(moved & up_to_date(status, F.col("last_modified"), F.col("date_updated"))).alias("newly_marked"),
        F.count_if(status == "no_pdf").alias("no_pdf_recovered"), F.count_if(~matched).alias("absent"),
    )


def upgrade_candidates(manifest: DataFrame, fallback: str, max_attempts: int | None = None) -> DataFrame:
    rows = manifest.where((F.col("status") == "done") & (F.col("converter") == fallback))
    return rows if max_attempts is None else rows.where(F.col("upgrade_attempts") < max_attempts)


def rows_for_upgrade(manifest: DataFrame, asked: DataFrame, fallback: str) -> DataFrame:
    """Rows of the ids asked for that are still done by the fallback; their status stays, moved ones drop out."""
    still = manifest.where((F.col("status") == "done") & (F.col("converter") == fallback))
    return still.join(asked.select("arxiv_id"), "arxiv_id", "left_semi")


def unknown_converters(manifest: DataFrame) -> DataFrame:
    """Done papers converted here (only that gives a count of characters) by a converter that isn't on record."""
    return manifest.where("status = 'done' and converter is null and n_chars is not null").select("arxiv_id")


def paper_row(manifest: DataFrame, asked: DataFrame) -> DataFrame:
    """(arxiv_id, version, title, categories, attempts, known) of each id asked for; unknown papers get defaults."""
    m = manifest.select("arxiv_id", F.col("version").alias("_v"), "title", "categories", "attempts", F.lit(True).alias("known"))
    j = asked.select("arxiv_id", "version").join(m, "arxiv_id", "left")
    none = F.array().cast("array<string>")
    return j.select(
        "arxiv_id", F.coalesce("version", "_v", F.lit("v1")).alias("version"), F.coalesce("title", "arxiv_id").alias("title"), F.coalesce("categories", none).alias("categories"),
        F.coalesce("attempts", F.lit(0)).alias("attempts"), F.coalesce("known", F.lit(False)).alias("known"),
    )


def record_converters(manifest: DataFrame, pairs: DataFrame) -> DataFrame:
    """Fill the converter of done papers where it is unknown."""
    p = pairs.groupBy(F.col("arxiv_id").alias("_k")).agg(F.max("converter").alias("_c"))
    filled = F.when(F.col("status") == "done", F.coalesce("converter", "_c")).otherwise(F.col("converter"))
    return manifest.join(p, manifest["arxiv_id"] == p["_k"], "left").withColumn("converter", filled).select(*manifest.columns)


def journal_ids(manifest: DataFrame, since: str | None = None) -> DataFrame:
    """Ids to publish: all done ones, or those this device completed since a time."""
    done = manifest.where("status = 'done'")
    return (done if since is None else done.where(~F.col("remote_only") & (F.col("completed_at") >= since))).select("arxiv_id")


def retry_in_run(attempts: Column, used: Column, status: Column, max_attempts: int | None, stopping: Column) -> Column:
    ok = (status != "no_pdf") & ~stopping
    return ok if max_attempts is None else ok & (attempts + used + 1 < max_attempts)


def work_order(manifest: DataFrame, requeued: DataFrame, upgrades: DataFrame, part: tuple[int, int] | None, max_attempts: int, listing: DataFrame | None = None) -> DataFrame:
    """Worklist by priority: requeued, retry, upgrade, fresh, then papers of other slices not yet stored; each paper once."""
    rest = claimable(manifest, FRESH + RETRYABLE, max_attempts).where(~slice_predicate(part))
    if listing is not None:
        rest = rest.join(listing.select("arxiv_id"), "arxiv_id", "left_anti")
    parts = [claim_ids(manifest, requeued), claimable(manifest, RETRYABLE, max_attempts, part), manifest.join(upgrades.select("arxiv_id"), "arxiv_id", "left_semi"), claimable(manifest, FRESH, max_attempts, part), rest]
    union = None
    for priority, rows in enumerate(parts):
        own = rows.select("arxiv_id", F.lit(priority).alias("priority"))
        union = own if union is None else union.unionByName(own)
    return union.groupBy("arxiv_id").agg(F.min("priority").alias("priority"))


def migrate(snapshot: DataFrame, schema_defaults: dict[str, Column]) -> DataFrame:
    """Additive schema change: missing columns with their defaults, the bucket computed where it is unset."""
    out = snapshot
    for name, default in schema_defaults.items():
        if name not in out.columns:
            out = out.withColumn(name, default)
    return out.withColumn("bucket", F.when(F.coalesce(F.col("bucket"), F.lit(-1)) < 0, ids.bucket_for(F.col("arxiv_id"))).otherwise(F.col("bucket"))) if "bucket" in out.columns else out.withColumn("bucket", ids.bucket_for(F.col("arxiv_id")))


def _due(manifest: DataFrame) -> DataFrame:
    """(arxiv_id, kind, name) of the files that done local papers should have."""
    local = manifest.where((F.col("status") == "done") & ~F.col("remote_only"))
    kinds = F.filter(
        F.array(*(F.struct(F.lit(k).alias("kind"), ids.object_name(k, F.col("arxiv_id")).alias("name"), (F.lit(k != "tables") | (F.coalesce("n_tables", F.lit(0)) > 0)).alias("due")) for k in ("md", "tables", "meta"))), lambda x: x["due"]
    )
    return local.select("arxiv_id", F.explode(kinds).alias("f")).select("arxiv_id", "f.kind", "f.name")


def missing_artefacts(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """(arxiv_id, kind, name) of files that done local papers should have and the listing doesn't show."""
    return _due(manifest).join(listing.select("name"), "name", "left_anti").select("arxiv_id", "kind", "name")


def verify(manifest: DataFrame, listing: DataFrame, refuse_above: float = 0.5) -> tuple[DataFrame, bool]:
    """(missing files, whether to refuse a reset because too many papers miss some); the flag takes two counts."""
    missing = missing_artefacts(manifest, listing)
    checked, lost = (rows.agg(F.countDistinct("arxiv_id")).first()[0] for rows in (_due(manifest), missing))
    return missing, bool(checked) and lost / checked > refuse_above
