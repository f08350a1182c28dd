"""Sources, sinks and streams of upkeep that no table can show."""

import datetime as dt
import gzip
import json
from xml.etree import ElementTree

import pytest
import yaml
from pyspark.sql import functions as F

from skein import streaming
from skein.functions import text
from skein.operators import partition, sinks
from skein.sources import harvest, snapshot


def feed(days, total):
    entries = "".join(f"<entry><id>http://x/abs/{i}</id><updated>{d}T00:00:00Z</updated></entry>" for i, d in enumerate(days))
    return f'<feed xmlns:o="os"><o:totalResults>{total}</o:totalResults>{entries}</feed>'.encode()


def test_search_pages_newest_first():
    days = [f"2026-01-{d:02}" for d in range(30, 0, -1)]
    asked, slept = [], []

    def get(url):
        start = int(url.split("start=")[1].split("&")[0])
        asked.append(start)
        if start == 10 and asked.count(10) == 1:
            return 200, feed([], 30), {}  # an empty page inside the listing
        return 200, feed(days[start : start + 10], 30), {}

    page = lambda start: harvest.search_page("http://x", "cat:*", start, 10, get, slept.append)
    found, complete = harvest.newest_first(page, "2026-01-15", "2026-01-28")
    assert complete and len(found) == 14 and asked == [0, 10, 10] and slept == [3.0]
    assert harvest.newest_first(page, "2025-01-01")[1] and len(harvest.newest_first(page, "2025-01-01")[0]) == 30
    assert not harvest.newest_first(page, "2025-01-01", most=20)[1]
    blank = lambda start: harvest.search_page("http://x", "q", start, 10, lambda url: (200, feed([], 30), {}), slept.append, 2)
    assert harvest.newest_first(blank, "2026-01-01") == ([], False)
    late = [*days[:9], "2025-12-31"]  # the last entry of a page decides, not one within it
    pages = {0: (late, 30), 10: (days[10:20], 30)}
    found, complete = harvest.newest_first(lambda start: ([e for e in ElementTree.fromstring(feed(*pages[start])).iter() if e.tag == "entry"], 30), "2026-01-01")
    assert complete and len(found) == 9


def test_source_by_config():
    assert harvest.source_format({}) == "skein_search" and harvest.source_format({"source": "oai"}) == "skein_oai"
    with pytest.raises(ValueError, match="api, oai"):
        harvest.source_format({"source": "rss"})


def test_markers_are_read_back(spark, tmp_path):
    sinks.write_marker(spark, str(tmp_path), "d1", (0, 128), "running", "2026-01-01T00:00:00+00:00")
    sinks.write_marker(spark, str(tmp_path), "d2", None, "idle", "2026-01-01T00:00:00+00:00")
    sinks.write_marker(spark, str(tmp_path), "d1", (0, 64), "running", "2026-01-02T00:00:00+00:00")
    rows = snapshot.read_json_documents(spark, str(tmp_path), "device string, range array<int>, updated_at string, run struct<state:string>").where("device is not null")
    assert sorted((r.device, r.range, r.run.state, r.updated_at[:10]) for r in rows.collect()) == [("d1", [0, 64], "running", "2026-01-02"), ("d2", None, "idle", "2026-01-01")]


def test_cache_is_kept_and_rebuilt(spark, tmp_path):
    files = spark.createDataFrame([("a", 5), ("b", 7)], "name string, size long")
    frames = lambda n: {"one": spark.createDataFrame([(n, "x")], "n int, t string")}
    at = str(tmp_path / "cache")
    assert sinks.cached(frames(1), files, at)["one"].collect() == [(1, "x")]
    assert sinks.cached(frames(2), files, at)["one"].collect() == [(1, "x")]  # same source
    assert sinks.cached(frames(3), files.withColumn("size", F.col("size") + 1), at)["one"].collect() == [(3, "x")]


def test_journal_stream_publishes_once(spark, tmp_path):
    source, root, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    for n, ids in enumerate((["1", "2"], ["3"])):
        spark.createDataFrame([(i,) for i in ids], "arxiv_id string").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("arxiv_id string").parquet(source)
        streaming.stream_done(stream, "d1", root, check).awaitTermination()
        assert sorted(r.id for r in spark.read.option("recursiveFileLookup", "true").text(root).select(F.col("value").alias("id")).collect()) == ["1", "2", "3"][: 2 + n]
    assert all(gzip.decompress(p.read_bytes()) for p in (tmp_path / "out" / "d1").rglob("*.gz"))


def test_harvest_moves_the_watermark_only_when_complete(spark):
    have = spark.createDataFrame([("1", "v1", "done", dt.date(2026, 1, 1)), ("2", "v1", "done", dt.date(2026, 1, 2))], "arxiv_id string, version string, status string, date_updated date")
    got = spark.createDataFrame([("2", "v2", dt.date(2026, 1, 5)), ("3", "v1", dt.date(2026, 1, 4)), ("1", "v1", dt.date(2026, 1, 1))], "arxiv_id string, version string, date_updated date")
    new, changed, mark = streaming.harvest(have, got, True, "2026-01-02")
    assert [r.arxiv_id for r in new.collect()] == ["3"] and mark == "2026-01-05"
    assert {r.arxiv_id: r.change for r in changed.collect()} == {"1": "unchanged", "2": "bump", "3": "insert"}
    assert streaming.harvest(have, got, False, "2026-01-02")[2] == "2026-01-02" and streaming.harvest(have, got, True, "2026-01-02", True)[2] == "2026-01-02"
    again, _, mark = streaming.harvest(have, got.limit(0), True, "2026-01-02")
    assert again.count() == 0 and mark == "2026-01-02"


def test_front_matter_reads_back(spark):
    rows = [("a: b", 'say "hi"\\', ["x.y", "no", "é"], 3), ("plain words", None, [], None), ("yes", "", ["1"], 0), ("line\nbreak\ttab", "- item", None, 1)]
    df = spark.createDataFrame(rows, "title string, doi string, categories array<string>, n int")
    head = text.front_matter({"title": F.col("title"), "doi": F.col("doi")}, {"n": F.col("n")}, {"categories": F.col("categories")})
    for (title, doi, cats, n), r in zip(rows, df.select(head.alias("h")).collect(), strict=True):
        assert r.h.startswith("---\n") and r.h.endswith("---\n\n")
        want = {k: v for k, v in (("title", title), ("doi", doi), ("n", n), ("categories", cats)) if v not in (None, "", [])}
        assert yaml.safe_load(r.h[4:-5]) == want


def test_memory_floor():
    assert text.memory_floor("4GB", 1) == 4 << 30 and text.memory_floor("512 MiB", 1) == 512 << 20 and text.memory_floor(0.25, 1000) == 250 and text.memory_floor(4096, 1) == 4096
    assert text.memory_floor(None, 1) is None and text.memory_floor("off", 1) is None and text.memory_floor(0, 1) is None
    with pytest.raises(ValueError, match="memory floor"):
        text.memory_floor("lots", 1)


def test_plans_of_any_length_keep_their_owners(spark):
    plan = [(f"empty{i}", 7, 7) for i in range(400)] + [("a", 0, 100), ("b", 100, 256), ("c", 90, 101)]
    p = spark.createDataFrame(plan, "device string, lo int, hi int")
    rows = spark.createDataFrame([(5,), (255,), (95,)], "bucket int")
    assert sorted((r.bucket, r.device) for r in partition.owners(rows, p).collect()) == [(5, "a"), (95, "a"), (95, "c"), (255, "b")]
    assert sorted((r.device_a, r.device_b) for r in partition.overlaps(p).collect()) == [("a", "c"), ("b", "c")]


def test_names_keep_folders_called_like_the_root(spark, tmp_path):
    root = tmp_path / "st+ore"
    (root / "md" / "st+ore").mkdir(parents=True)
    (root / "md" / "st+ore" / "x.md").write_text("x")
    assert [r.name for r in snapshot.list_objects(spark, str(root)).collect()] == ["md/st+ore/x.md"]


def test_reports_of_checkpoints_are_json(spark, tmp_path):
    (tmp_path / "w.json").write_text(json.dumps({"slot": 3, "done": 2}))
    assert [r.slot for r in snapshot.read_json_documents(spark, str(tmp_path), snapshot.WORKER).collect()] == [3]
