"""Registered queries over every row of their input: ids, languages and keys that a subset would leave out, against brute force in Python."""

import shutil
from collections import Counter

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from skein.plans import registry

IDS = [0, 1, 3, 25, 199, 200, 207, 999, 1000, 1001, 1008, 20_999, 123_456]


@pytest.fixture(scope="module")
def wide(sf, tmp_path_factory):
    """A folder of tables whose documents have ids far apart and texts in several scripts."""
    at = tmp_path_factory.mktemp("wide")
    for t in ("nation", "orders"):
        shutil.copy(f"{sf}/{t}.parquet", at)
    texts = [f"Zeile {i}  größer\t\tça  va \n\n | a | é | \nплан {i}\n|x|" if i % 2 else f"plain  {i}\n| b |\nend" for i in IDS]
    pq.write_table(pa.table({"doc_id": IDS, "text": texts, "lang": ["de"] * len(IDS), "source": ["src 1"] * len(IDS), "n_chars": [len(t) for t in texts]}), at / "documents.parquet")
    return str(at)


def nations(wide, region):
    return [(r["n_nationkey"], r["n_name"]) for r in sorted(pq.read_table(f"{wide}/nation.parquet").to_pylist(), key=lambda r: r["n_nationkey"]) if r["n_regionkey"] == region]


def test_tables_of_every_document(spark, wide):
    got = {r.doc: (r["index"], r.n_rows, r.n_cols, r.caption, r.markdown) for r in registry.QUERIES["lift_tables"](spark, wide).collect()}
    want = {}
    for i in IDS:
        rows = nations(wide, i % 5)
        want[i] = (1, len(rows), 3, "Table 1: nations", "\n".join(["| key | name | z |", "| --- | --- | --- |", *(f"| {k} | {n} | x |" for k, n in rows)]))
    assert got == want


def test_bodies_of_every_document(spark, wide):
    got = {r.doc: r.body for r in registry.QUERIES["bodies_without_tables"](spark, wide).collect()}
    assert got == dict.fromkeys(IDS, "Head\nTable 1: nations\n[[TABLE:1]]\ntail line\n\nend")


def test_object_names_of_every_document(spark, wide):
    got = {r.doc_id: r.id for r in registry.QUERIES["ids_from_object_names"](spark, wide).collect()}
    assert got == {i: f"{7 + i % 17:02}{1 + i % 12:02}.{i:05}" if i % 2 else f"hep-th/{92 + i % 7:02}{1 + i % 12:02}{i % 1000:03}" for i in IDS}


def documents(wide):
    return pq.read_table(f"{wide}/documents.parquet").to_pylist()


def test_scalars_of_every_text(spark, wide):
    got = {r.doc_id: (r.collapsed, r.bucket, r.device) for r in registry.QUERIES["scalar_text"](spark, wide).collect()}
    assert got == {r["doc_id"]: (" ".join(r["text"].split()), r["n_chars"] // 10 * 10, "src-1-de") for r in documents(wide)}


def test_pipe_lines_of_every_text(spark, wide):
    got = {r.doc: (r.pipe_lines, r.n_lines) for r in registry.QUERIES["pipe_lines"](spark, wide).collect()}
    lines = {r["doc_id"]: r["text"].split("\n") for r in documents(wide)}
    assert got == {i: (sum(len(x := y.strip()) > 1 and x[0] == x[-1] == "|" for y in ys), len(ys)) for i, ys in lines.items()}


def test_equations_of_every_document(spark, wide):
    got = {r.doc: r.body for r in registry.QUERIES["mark_equations"](spark, wide).collect()}
    assert got == dict.fromkeys(IDS, "$$ a = b + c $$\nwhere the value = of all parts\n# a = b\n$$ E = mc^2   (1) $$\nshort\n```\nx = y + z")


def test_trailing_means_of_every_order(spark, wide):
    n = Counter((r["o_orderpriority"], r["o_orderdate"].year * 12 + r["o_orderdate"].month - 1) for r in pq.read_table(f"{wide}/orders.parquet").to_pylist())
    months = range(min(m for _, m in n), max(m for _, m in n) + 1)
    want = {}
    for key in {k for k, _ in n}:
        for m in months:
            last = [n[key, x] for x in months if m - 12 < x <= m]
            want[key, m] = (n[key, m], round(sum(last) / len(last), 9))
    got = {(r.key, r.month.year * 12 + r.month.month - 1): (r.n, round(r.rolling, 9)) for r in registry.QUERIES["monthly_trailing_mean"](spark, wide).collect()}
    assert got == want


def test_shards_of_every_id(spark, tmp_path):
    """Ids around and far above 100,000, negative and null ones, and null sizes, against the query's SQL."""
    found = [None, None, *range(-500, 300), *range(99_800, 100_200), 1_000_000, 123_456_789, 2**40, 2**63 - 1, -123_452, -(2**63)]
    sizes = [None if k % 13 == 5 else k * 37 % 1000 for k in range(len(found))]
    same = [["x"] * len(found)] * 3
    pq.write_table(pa.table([pa.array(found, pa.int64()), *same, pa.array(sizes, pa.int64())], ["doc_id", "text", "lang", "source", "n_chars"]), tmp_path / "documents.parquet")
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{tmp_path}/documents.parquet'")
    sql = c.sql(registry.ORACLES["shard_counts"])
    got = Counter(tuple(r) for r in registry.QUERIES["shard_counts"](spark, str(tmp_path)).select(*sql.columns).collect())
    assert got == Counter(sql.fetchall())
    assert sum(r[2] for r in got.elements()) == len(found)
