"""Incremental forms: result folding, journals, overlapping harvests, staleness."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skein.operators import manifest
from skein.sources import snapshot


def fold_results(events: DataFrame, checkpoint: str, read: Callable[[], DataFrame], write: Callable[[DataFrame, int], None], trigger: dict | None = None) -> StreamingQuery:
    """Fold a stream of task results into the snapshot, batch by batch.

    write(snapshot, batch) must replace the snapshot of that batch number, so a repeated batch changes nothing.
    """

    def one(batch: DataFrame, number: int) -> None:
        write(manifest.apply_results(read(), manifest.fold_events(batch)), number)

    return events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(one).trigger(**(trigger or {"availableNow": True})).start()


def stream_journal(spark: SparkSession, root: str, own: str | None = None) -> DataFrame:
    """(device, segment, id) of segments as they appear; the checkpoint is the cursor of every device."""
    lines = spark.readStream.schema("value string").option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true").text(root)
    return snapshot._journal(lines.select("value", F.col("_metadata.file_path").alias("path")), None, own)


def without_repeats(stream: DataFrame, key: str, time: str, overlap: str = "2 days") -> DataFrame:
    """Rows of overlapping harvests once each. A time without zone is cast, as watermarks need."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp"))
    return timed.withWatermark(time, overlap).dropDuplicatesWithinWatermark([key])


def stream_log(spark: SparkSession, root: str) -> DataFrame:
    """(id, converter) of fallback lines as a log grows by files."""
    from skein.functions.text import fallback_in_line

    lines = spark.readStream.schema("value string").text(root)
    return lines.select(fallback_in_line(F.col("value")).alias("f")).where("f.id is not null").select("f.*")


def stream_done(done: DataFrame, device: str, root: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Publish a stream of finished ids (arxiv_id) as gzip'd journal segments root/device=<d>/seq=<batch>.

    A batch's segment replaces itself, so a batch that is repeated after a failure is published once.
    """

    def one(batch: DataFrame, number: int) -> None:
        batch.select(F.col("arxiv_id").alias("value")).write.mode("overwrite").option("compression", "gzip").text(f"{root}/{device}/{number:010d}")

    return done.writeStream.option("checkpointLocation", checkpoint).foreachBatch(one).trigger(**(trigger or {"availableNow": True})).start()


def harvest(manifest_rows: DataFrame, fetched: DataFrame, complete: bool, watermark: str | None, dry_run: bool = False) -> tuple[DataFrame, DataFrame, str | None]:
    """(new rows, updates as manifest.classify gives them, the next watermark) of one harvest run.

    Days that are read again give rows that are known already, which neither count nor change anything.
    """
    new = manifest.insert_new(manifest_rows, fetched)
    changed = manifest.classify_updates(manifest_rows, fetched)
    latest = fetched.agg(F.max(F.col("date_updated").cast("string"))).first()[0]
    return new, changed, next_watermark(watermark, latest, complete, dry_run)


def next_start(watermark: str | None, latest: str | None, overlap: int, told: str | None = None) -> str | None:
    """First day of the next harvest: as told, else the watermark or the latest date, less the overlap."""
    import datetime as dt

    if told:
        return told
    base = watermark or latest
    return None if base is None else (dt.date.fromisoformat(base[:10]) - dt.timedelta(days=overlap)).isoformat()


def next_watermark(current: str | None, seen_latest: str | None, complete: bool, dry_run: bool) -> str | None:
    """The watermark moves only after a complete run that wasn't a rehearsal."""
    return seen_latest if complete and not dry_run and seen_latest else current
