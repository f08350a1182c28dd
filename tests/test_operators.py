import datetime as dt
import gzip
import json

from pyspark.sql import functions as F

from skein.operators import converters, sinks, tables
from skein.operators import manifest as mf
from skein.sources import harvest, snapshot
from skein import streaming

MANIFEST = "arxiv_id string, version string, status string, attempts int, upgrade_attempts int, pdf_bytes long, md_bytes long, converter string, error string, completed_at timestamp_ntz, date_updated date, remote_only boolean, bucket int, n_tables int"


def rows(spark, *changes):
    base = dict(arxiv_id="a", version="v1", status="pending", attempts=0, upgrade_attempts=0, pdf_bytes=None, md_bytes=None, converter=None, error=None, completed_at=None, date_updated=None, remote_only=False, bucket=1, n_tables=0)
    return spark.createDataFrame([tuple((base | c).values()) for c in changes], MANIFEST)


def event(**c):
    return tuple((dict(paper="a", seq=1, ts=dt.datetime(2026, 1, 1), status="done", pdf_bytes=None, md_bytes=None, error=None, count_attempt=True, upgrade=False) | c).values())


EVENT = "paper string, seq long, ts timestamp_ntz, status string, pdf_bytes long, md_bytes long, error string, count_attempt boolean, upgrade boolean"


def test_snapshot_reader(spark, tmp_path):
    p = tmp_path / "s.jsonl"
    p.write_text('{"id": "1", "title": "t"}\n\n{not json}\n{"id": "2", "versions": [{"version": "v1", "created": "x"}]}\n')
    assert sorted(r.id for r in snapshot.read_snapshot(spark, str(p)).collect()) == ["1", "2"]
    assert snapshot.read_snapshot(spark, str(p), 1).count() == 1 and snapshot.read_snapshot(spark, str(p)).count() == 2
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "worker-1.json").write_text('{"slot": 1,\n "done": 5}')
    (tmp_path / "w" / "worker-2.json").write_text('{"slot": 2, "do')
    assert [r.done for r in snapshot.read_json_documents(spark, str(tmp_path / "w"), snapshot.WORKER).collect()] == [5]
    assert [r.line for r in snapshot.malformed_lines(spark, str(p)).collect()] == ["{not json}"]


def test_oai_and_feed(spark, tmp_path):
    oai = tmp_path / "oai.xml"
    oai.write_text('<r><record><header><identifier>x</identifier><datestamp>2026-01-02</datestamp></header><metadata><arXivRaw><id>1</id><version version="v1"><date>Mon, 2 Apr 2007 19:18:42 GMT</date></version><version version="v2"><date>Tue, 3 Apr 2007 19:18:42 GMT</date></version><title>T</title><authors>A B</authors><categories>cs.LG</categories></arXivRaw></metadata></record><record><header status="deleted"><identifier>y</identifier></header></record></r>')
    got = snapshot.oai_to_snapshot(snapshot.read_oai(spark, str(oai))).collect()
    assert [(r.id, [v.version for v in r.versions], r.update_date) for r in got] == [("1", ["v1", "v2"], "2026-01-02")]
    feed = tmp_path / "feed.xml"
    feed.write_text('<feed><entry><id>https://example.org/abs/2301.00001v3</id><title>A\n B</title><updated>2026-02-01T00:00:00Z</updated><published>2026-01-01T00:00:00Z</published><category term="cs.LG"/><category term="stat.ML"/><arxiv:primary_category xmlns:arxiv="u" term="stat.ML"/><author><name>X Y</name></author></entry></feed>')
    r = snapshot.feed_to_snapshot(snapshot.read_feed(spark, str(feed))).first()
    assert (r.id, r.title, r.categories, r.update_date, r.versions[1].version) == ("2301.00001", "A B", "stat.ML cs.LG", "2026-02-01", "v3")


def test_harvest_pages_follow_tokens_and_fail_over():
    page = lambda n, token="": f"<OAI><ListRecords><record>{n}</record><resumptionToken>{token}</resumptionToken></ListRecords></OAI>".encode()
    seen = []

    def get(url):
        seen.append(url)
        if url.startswith("bad"):
            return 503, b"", {"Retry-After": "1"}
        return 200, page(2) if "resumptionToken=t" in url else page(1, "t"), {}

    waits = []
    got = [r.text for p in harvest.pages(["bad", "good"], "from=x", get, waits.append) for r in p]
    assert got == ["1", "2"] and waits == [1.0] * 4
    assert harvest.retry_delay(1, 200.0, 503, None) == 60.0 and harvest.retry_delay(2, 200.0, 503, None) == 120.0 and harvest.retry_delay(3, 0.1, 503, None) == 8.0


def test_journal_round_trip_and_torn_segment(spark, tmp_path):
    done = rows(spark, *({"arxiv_id": f"2301.{i:05d}", "status": "done"} for i in range(25)))
    seg = sinks.journal_segments(mf.journal_ids(done), "d1", first=3, size=10)
    assert seg.count() == 25 and seg.select("seq").distinct().count() >= 3
    for d, s, ids in (("d1", 1, ["a", "b"]), ("d1", 2, ["c"]), ("d2", 1, ["x"])):
        (tmp_path / d).mkdir(exist_ok=True)
        (tmp_path / d / f"{s:010d}.txt.gz").write_bytes(gzip.compress("\n".join(ids).encode()))
    (tmp_path / "d1" / "0000000003.txt.gz").write_bytes(gzip.compress(b"zzzz" * 99)[:20])
    cursors = spark.createDataFrame([("d1", "0000000001")], "device string, cursor string")
    assert sorted(r.id for r in snapshot.read_journal(spark, str(tmp_path), cursors).collect()) == ["c", "x"]
    assert sorted(r.id for r in snapshot.read_journal(spark, str(tmp_path), None, "d2").collect()) == ["a", "b", "c"]


def test_fold_keeps_old_values_and_counts_upgrades(spark):
    events = spark.createDataFrame([event(seq=1, status="in_flight", pdf_bytes=4242, count_attempt=False), event(seq=2, md_bytes=17), event(seq=3, status="failed_convert", upgrade=True, error="e")], EVENT)
    f = mf.fold_events(events, columns=("pdf_bytes", "md_bytes")).first()
    assert (f.status, f.pdf_bytes, f.md_bytes, f.attempts, f.upgrade_attempts, f.error) == ("done", 4242, 17, 1, 1, None) and f.completed_at is not None
    old = rows(spark, {"pdf_bytes": 7, "attempts": 2})
    r = mf.apply_results(old, mf.fold_events(spark.createDataFrame([event(status="failed_convert", md_bytes=3, error="x")], EVENT), columns=("pdf_bytes", "md_bytes")), columns=("pdf_bytes", "md_bytes")).first()
    assert (r.status, r.pdf_bytes, r.md_bytes, r.attempts, r.error, r.completed_at) == ("failed_convert", 7, 3, 3, "x", None)


def test_claims_and_resets(spark):
    m = rows(spark, *({"arxiv_id": str(a), "status": "failed_download", "attempts": a} for a in (1, 2, 4)))
    assert mf.claimable(m, mf.RETRYABLE, 4).count() == 2 and mf.claimable(m, mf.RETRYABLE).count() == 3
    assert mf.claimable(m, mf.RETRYABLE, None, (0, 0)).count() == 0 and mf.claimable(m, mf.RETRYABLE, None, (1, 2)).count() == 3
    m = rows(spark, {"arxiv_id": "x", "status": "failed_download", "attempts": 9}, {"arxiv_id": "y", "status": "failed_convert", "attempts": 1, "error": "e"}, {"arxiv_id": "z", "status": "in_flight"})
    got = {r.arxiv_id: (r.status, r.error) for r in mf.reset_failed(mf.reset_stale(m)).collect()}
    assert got == {"x": ("failed_download", None), "y": ("pending", None), "z": ("pending", None)}


def test_updates_and_observations(spark):
    day = dt.date(2026, 11, 5)
    m = rows(spark, {"arxiv_id": "d", "status": "done", "attempts": 3}, {"arxiv_id": "f", "status": "in_flight"}, {"arxiv_id": "e", "status": "failed_convert", "attempts": 2})
    inc = spark.createDataFrame([("d", "v2", day), ("f", "v2", day), ("e", "v10", day), ("n", "v1", day)], "arxiv_id string, version string, date_updated date")
    assert {r.arxiv_id: r.change for r in mf.classify_updates(m, inc).collect()} == {"d": "bump", "f": "unchanged", "e": "bump", "n": "insert"}
    got = {r.arxiv_id: (r.version, r.status, r.attempts) for r in mf.apply_updates(m, inc).collect()}
    assert got == {"d": ("v2", "outdated", 0), "f": ("v1", "in_flight", 0), "e": ("v10", "failed_convert", 2)}
    m = rows(spark, {"arxiv_id": "o", "status": "outdated", "date_updated": day}, {"arxiv_id": "q", "status": "outdated", "date_updated": day}, {"arxiv_id": "p", "status": "no_pdf"})
    found = spark.createDataFrame([("o", 1, dt.datetime(2026, 11, 1)), ("q", 2, dt.datetime(2026, 11, 7)), ("p", 3, None), ("zz", 3, None)], "arxiv_id string, size long, last_modified timestamp_ntz")
    assert {r.arxiv_id: (r.status, r.md_bytes) for r in mf.mark_done(m, found).collect()} == {"o": ("outdated", None), "q": ("done", 2), "p": ("done", 3)}
    r = mf.observation_report(m, found).first()
    assert (r.matched, r.newly_marked_dry, r.newly_marked, r.no_pdf_recovered, r.absent) == (3, 3, 2, 1, 1)


def test_inserts_are_idempotent(spark):
    new = rows(spark, *({"arxiv_id": str(i)} for i in range(10)))
    empty = new.limit(0)
    first = mf.insert_new(empty, new)
    assert first.count() == 10 and mf.insert_new(first, new).count() == 0
    more = rows(spark, *({"arxiv_id": str(i)} for i in range(5, 15)))
    assert mf.insert_new(first, more).count() == 5


def test_tables_and_captions(spark):
    body = "Intro\n| a | b | c |\n|---|---|---|\n| 1 | 2 | 3 |\n\nTable 2: below\nx\n| h |\n|---|\n\nProcedure 1 find\n| s |\n|---|\n| do it |\n| end |\n"
    docs = spark.createDataFrame([("d", body), ("e", "no table")], "doc string, body string")
    t, b = tables.lift_tables(docs)
    assert [(r["index"], r.n_rows, r.n_cols, r.caption) for r in t.collect()] == [(1, 1, 3, "Table 2: below")]
    bodies = {r.doc: r.body for r in b.collect()}
    assert "[[TABLE:1]]" in bodies["d"] and "```text" in bodies["d"] and bodies["e"] == "no table"


def test_converter_chain(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"one\ftwo")
    converters.register("broken", lambda: lambda raw: 1 / 0)
    files = spark.read.format("binaryFile").load(str(tmp_path))
    r = converters.convert(files, ["broken", "plain"]).first()
    assert (r.body, r.n_pages, r.converter, r.fell_back) == ("one\ntwo", 2, "plain", True) and "ZeroDivisionError" in r.error
    r = converters.convert(files, ["broken"]).first()
    assert r.body is None and "broken" in r.error


def test_streaming_fold_and_journal(spark, tmp_path):
    src, ck = tmp_path / "events", tmp_path / "ck"
    cols = mf.FOLDED
    ev = spark.createDataFrame([event(seq=1, status="in_flight"), event(seq=2, md_bytes=5)], EVENT)
    for c in cols:
        if c not in ev.columns:
            ev = ev.withColumn(c, F.lit(None).cast("string" if c == "converter" else "long"))
    ev.write.parquet(str(src))
    snap = rows(spark, {"arxiv_id": "a"}).drop("n_tables")
    for c in ("tables_bytes", "n_pages", "n_tables", "n_chars"):
        snap = snap.withColumn(c, F.lit(None).cast("long"))
    snap.write.parquet(str(tmp_path / "snap0"))
    state = {"at": str(tmp_path / "snap0")}

    def write(df, n):
        df.write.mode("overwrite").parquet(str(tmp_path / f"snap{n + 1}"))
        state["at"] = str(tmp_path / f"snap{n + 1}")

    q = streaming.fold_results(spark.readStream.schema(ev.schema).parquet(str(src)), str(ck), lambda: spark.read.parquet(state["at"]), write)
    q.awaitTermination(120)
    r = spark.read.parquet(state["at"]).first()
    assert (r.status, r.md_bytes, r.attempts) == ("done", 5, 2)
    j = tmp_path / "journal" / "d1"
    j.mkdir(parents=True)
    (j / "0000000001.txt.gz").write_bytes(gzip.compress(b"a\nb\n"))
    s = streaming.stream_journal(spark, str(tmp_path / "journal")).writeStream.format("memory").queryName("journal_test").trigger(availableNow=True).start()
    s.awaitTermination(120)
    assert sorted(r.id for r in spark.table("journal_test").collect()) == ["a", "b"]


def test_sinks(spark, tmp_path):
    c = spark.createDataFrame([("2301.00001", "v1", "T", ["A"], ["cs.LG"], "cs.LG", "", "2023-01-01", "2023-01-02", 3, 1, 10, "plain", "see [[TABLE:1]]")], "arxiv_id string, version string, title string, authors array<string>, categories array<string>, primary_category string, doi string, date_released string, date_updated string, n_pages int, n_tables int, n_chars int, converter string, body string")
    t = spark.createDataFrame([("2301.00001", 1, "Table 1", ["k"], 1, "| k |")], "arxiv_id string, index int, caption string, columns array<string>, n_rows int, markdown string")
    sinks.write_artefacts(c, t, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/md")).first().body.endswith("_tables.md#table-1)")
    meta = sinks.metadata(c)
    assert tuple(meta.columns) == sinks.METADATA and len(meta.columns) == 14
    flat = sinks.flatten(meta).first()
    assert flat.doi is None and json.loads(flat.raw)["arxiv_id"] == "2301.00001"
    assert sinks.merge_staged(meta, meta).count() == 1
