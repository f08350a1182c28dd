import datetime as dt

from pyspark.sql import functions as F

from skein.functions import ids, markdown, text
from skein.operators import partition as pt
from skein.operators import prepare
from skein.streaming import next_start, next_watermark


def col(spark, values, make, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in rows.select("i", make(F.col("v")).alias("x")).orderBy("i").collect()]


def test_identifiers(spark):
    assert col(spark, ["2301.00001", "hep-th/9901001", ""], ids.bucket_for) == [199, 234, 0]
    assert col(spark, ["2301.12345", "0704.0001", "hep-th/9901001", "math.GT/0309136", "cond-mat/0512345"], ids.shard_for) == ["2301", "0704", "9901", "0309", "0512"]
    assert set(col(spark, ["nothing", "2313.0001", "", "bar/7", "2399.00017", "2301"], ids.shard_for)) == {"misc"}
    assert col(spark, ["v10", "v2", None, "x"], ids.version_number) == [10, 2, 0, 0]
    assert col(spark, ["store/md/9901/hep-th_9901001.md", "store/md/9901/a.bak", "store/tables/9901/x_tables.md"], lambda c: ids.id_candidates(c, prefix="store")) == [["hep-th_9901001", "hep-th/9901001"], None, None]
    got = col(spark, ["https://arxiv.org/abs/2301.00001v2", "arXiv:hep-th/9901001", "2301.00001", "nonsense"], ids.parse_reference)
    assert [(r.id, r.version) for r in got] == [("2301.00001", "v2"), ("hep-th/9901001", None), ("2301.00001", None), (None, None)]


def test_text(spark):
    assert col(spark, [9, 60, 90, 3600, 5400, 21600], text.human_duration, "int") == ["9s", "1m", "1m30s", "1h00m", "1h30m", "6h00m"]
    assert col(spark, [12, 2048, 5 * 1024**3], text.human_size, "long") == ["12.0 B", "2.0 KB", "5.0 GB"]
    names = col(spark, ["Mary Somerville; George P. Boole (Cork (Ireland)), and Emmy Noether III"], text.split_authors)[0]
    assert names == [["Somerville", "Mary", ""], ["Boole", "George P.", ""], ["Noether", "Emmy", "III"]]
    bodies = [b"You has been blocked", b"Too Many Requests", b"PDF is being generated", b""]
    assert col(spark, bodies, text.looks_blocked, "binary") == [True, True, False, False]
    assert col(spark, ["---\nid: x\nconverter: 'fast'\n---\nconverter: no", "converter: no"], text.converter_in_front_matter) == ["fast", None]
    assert col(spark, ["Mon, 2 Apr 2007 19:18:42 GMT", "bad", None], text.rfc2822_date) == [dt.date(2007, 4, 2), None, None]
    windows = [("2007-01", None), ("2007-05", None), (None, "2007-04"), (None, "2007-03"), ("2007-04", "2007-04"), (None, None)]
    for (low, high), want in zip(windows, [True, False, True, False, True, True], strict=True):
        assert col(spark, ["2007-04-02"], lambda c, a=low, b=high: text.in_window(c, a, b)) == [want]
    assert col(spark, [None], lambda c: text.in_window(c, "2007-01", None)) == [False]


def test_versions_and_records(spark):
    v = [dict(version=n, created=d) for n, d in (("v10", "Tue, 24 Jul 2007 01:02:03 GMT"), ("v2", "Mon, 2 Apr 2007 04:05:06 GMT"))]
    rows = spark.createDataFrame([("0704.0001", " A \n title ", "hep-ph  cs.LG", [["Erdős", "P.", ""], ["", "", ""], ["Kiss", "A. B.", "Sr"]], v, "2008-11-26"), (None, None, None, None, [], None)], "id string, title string, categories string, authors_parsed array<array<string>>, versions array<map<string,string>>, update_date string")
    rows = rows.withColumn("versions", F.transform("versions", lambda x: F.struct(x["version"].alias("version"), x["created"].alias("created")))).withColumn("doi", F.lit("")).withColumn("comments", F.lit(None).cast("string"))
    a, b = sorted(prepare.parse_records(rows).collect(), key=lambda r: -len(r.arxiv_id))
    assert (a.version, a.title, a.authors, a.primary_category, a.date_released, a.date_updated, a.n_versions, a.doi) == ("v10", "A title", ["Erdős, P.", "Kiss, A. B. Sr"], "hep-ph", dt.date(2007, 4, 2), dt.date(2007, 7, 24), 2, None)
    assert (b.arxiv_id, b.version, b.date_released, b.authors, b.categories) == ("", "v1", None, [], [])
    assert prepare.in_scope(prepare.parse_records(rows), ["cs.LG"], date_from="2007-04").count() == 1
    assert prepare.to_rows(prepare.parse_records(rows)).where("arxiv_id <> ''").first().shard == "0704"


def test_markdown(spark):
    assert col(spark, ["One &amp;<BR>two<br />three", "a|b"], markdown.clean_cell) == ["One &amp; two three", r"a\|b"]
    assert col(spark, ["| a | b |", "a | | c", "||"], markdown.split_row) == [["a", "b"], ["a", "", "c"], [""]]
    grids = [[["a", "b"]], [[" ", ""], ["", " "]], [["x"] * 59] * 4, [["Col1", "Col2", "c"], ["1", "2", "3"]], [["k", "v"], ["1", "2"]]]
    assert col(spark, grids, markdown.is_degenerate, "array<array<string>>") == [True, True, True, True, False]
    assert col(spark, grids[2:3], lambda c: markdown.is_degenerate(c, 80), "array<array<string>>") == [False]
    assert col(spark, [[["a", "b"], ["1"]]], markdown.render_rows, "array<array<string>>") == ["\n".join(["| a | b |", "| --- | --- |", "| 1 |  |"])]
    code = [["1: Require x"], ["2: while x do"], ["3: return x"]]
    assert col(spark, [code, [["k", "v"], ["a", "1"], ["b", "2"]]], lambda c: markdown.looks_like_pseudocode(c, F.lit("")), "array<array<string>>") == [True, False]
    yes, no = ["x = y + z (3)", "∑ a_i ≤ b_j", "E = mc^2 - 4"], ["", "# a = b + c", "← ⊙", "where the loss = sum of all terms", "This line ends = here.", "plain words only here"]
    assert col(spark, yes + no, markdown.looks_like_display_equation) == [True] * 3 + [False] * 6
    assert markdown.html_rows('<table border="0"><tr><th class="k" colspan="3">R&amp;D</th></tr><tr><td>x<br/>y</td></tr></table>') == [["R&D"] * 3, ["x y"]]
    assert col(spark, ["<table><tr><td>x</td></tr></table>"], markdown.html_tables_to_pipe) == ["<table><tr><td>x</td></tr></table>"]
    assert col(spark, ["see [[TABLE:2]] and [[x"], lambda c: markdown.link_markers(c, F.lit("t.md"), F.lit(True))) == ["see [[TABLE:2]](t.md#table-2) and [[x"]


def test_partition_plans():
    assert pt.ranges_from_weights(["a", "b"], {"a": 60, "b": 40}) == {"a": (0, 154), "b": (154, 256)}
    r = pt.ranges_from_weights(["c", "b", "a"], dict(a=0.002, b=3000, c=0))
    assert r == {"c": (0, 0), "b": (0, 255), "a": (255, 256)}
    half, none = pt.equal_slice(2, 0), (10, 10)
    assert [pt.describe_slice(x) for x in (half, none)] == ["buckets 0-127 (50.0%)", "no share (0%)"]
    assert pt.read_plan(pt.write_plan(r)) == r and pt.read_plan("{bad") is None
    assert pt.read_plan('{"devices": 2, "assignments": {"x": 1}}') == {"x": (128, 256)}
    assert pt.resolve(None, {"x": (0, 9)}, "y", (1, 2), None) == (0, 0) and pt.resolve((3, 4), None, "", None, None) == (3, 4)
    assert pt.merge_shares({"a": 1, "b": 2}, {"c": 3}, drop=("a",)) == {"b": 2, "c": 3}


def test_harvest_marks():
    assert next_start(None, "2026-10-31", 2) == "2026-10-29" and next_start("2026-11-08", "2026-10-31", 2) == "2026-11-06" and next_start("2026-11-08", None, 2, told="2025-12-31") == "2025-12-31"
    assert next_watermark("a", "b", True, False) == "b" and next_watermark("a", "b", False, False) == "a" and next_watermark("a", "b", True, True) == "a"
