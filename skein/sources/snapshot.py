"""Readers: metadata snapshots, recorded XML pages and feeds, object listings, journals, markers, plans, logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT = (
    "id string, submitter string, authors string, title string, comments string, `journal-ref` string, doi string, categories string, license string, "
    "abstract string, update_date string, versions array<struct<version:string,created:string>>, authors_parsed array<array<string>>"
)
OAI = (
    "header struct<identifier:string,datestamp:string,_status:string>, metadata struct<arXivRaw:struct<id:string,version:array<struct<_version:string,date:string,size:string>>,"
    "title:string,authors:string,categories:string,doi:string>>"
)
ENTRY = (
    "id string, title string, updated string, published string, category array<struct<_term:string>>, `arxiv:primary_category` struct<_term:string>, `arxiv:doi` string, author array<struct<name:string>>"
)
META = (
    "arxiv_id string, version string, title string, authors array<string>, categories array<string>, primary_category string, doi string, date_released string, "
    "date_updated string, n_pages int, n_tables int, n_chars int, converter string, source_url string"
)
WORKER = "slot int, pid int, processed long, done long, failed long, no_pdf long, last_paper string, started_at string, updated_at string"


def _parsed(texts: DataFrame, schema: str) -> DataFrame:
    """(value, _r): each text as one JSON object; _r._corrupt is set where it isn't one."""
    parsed = F.from_json("value", schema + ", _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    good = F.trim("value").startswith("{")
    return texts.where(F.trim("value") != "").withColumn("_r", F.when(good, parsed)).withColumn("_good", F.col("_r").isNotNull() & F.col("_r._corrupt").isNull())


def read_snapshot(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Good records of a JSON Lines snapshot; blank and malformed lines are left out and don't count to the limit."""
    good = _parsed(spark.read.text(path), SNAPSHOT).where("_good").select("_r.*").drop("_corrupt")
    return good if limit is None else good.limit(limit)


def malformed_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line): what read_snapshot leaves out, for a log."""
    return _parsed(spark.read.text(path), SNAPSHOT).where("not _good").select(F.col("value").alias("line"))


def read_oai(spark: SparkSession, path: str) -> DataFrame:
    """Records of recorded ListRecords pages, deleted and empty ones included."""
    return spark.read.schema(OAI).option("rowTag", "record").xml(path)


def oai_to_snapshot(records: DataFrame) -> DataFrame:
    """Snapshot-shaped rows; deleted records and those without metadata are left out."""
    r = records.where("(header._status is null or header._status <> 'deleted') and metadata.arXivRaw.id is not null")
    m = "metadata.arXivRaw."
    return r.select(
        F.col(m + "id").alias("id"), F.col(m + "title").alias("title"), F.col(m + "authors").alias("authors"), F.col(m + "categories").alias("categories"), F.col(m + "doi").alias("doi"),
        F.transform(F.col(m + "version"), lambda v: F.struct(v["_version"].alias("version"), v["date"].alias("created"))).alias("versions"), F.col("header.datestamp").alias("update_date"),
    )


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Entries of recorded Atom pages."""
    return spark.read.schema(ENTRY).option("rowTag", "entry").xml(path)


def feed_to_snapshot(entries: DataFrame) -> DataFrame:
    """Snapshot-shaped rows; the history of versions holds the first and the latest one."""
    ref = F.regexp_extract("id", r"/abs/(.+?)(v\d+)?$", 1)
    version = F.regexp_extract("id", r"/abs/(.+?)(v\d+)?$", 2)
    primary = F.col("`arxiv:primary_category`._term")
    terms = F.filter(F.array_distinct(F.concat(F.array(primary), F.transform("category", lambda c: c["_term"]))), lambda c: c.isNotNull())
    stamp = lambda c: F.concat(F.date_format(F.to_timestamp(c), "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    history = F.array(F.struct(F.lit("v1").alias("version"), stamp("published").alias("created")), F.struct(F.when(version == "", "v1").otherwise(version).alias("version"), stamp("updated").alias("created")))
    return entries.where(ref != "").select(
        ref.alias("id"), F.trim(F.regexp_replace("title", r"\s+", " ")).alias("title"), F.array_join(F.transform("author", lambda a: a["name"]), ", ").alias("authors"),
        F.array_join(terms, " ").alias("categories"), F.col("`arxiv:doi`").alias("doi"), F.array_distinct(history).alias("versions"), F.substring("updated", 1, 10).alias("update_date"),
    )


def within(entries: DataFrame, since: str, until: str | None = None) -> DataFrame:
    """Rows whose update_date lies in [since, until]."""
    return entries.where((F.col("update_date") >= since) & (F.lit(True) if until is None else F.col("update_date") <= until))


def list_objects(spark: SparkSession, root: str, start_after: str | None = None) -> DataFrame:
    """(name, size, last_modified) of the files under root; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = root.split("://")[-1].strip("/") + "/"  # after its first occurrence the name begins, whatever folders it has
    name = F.substr("path", F.position(F.lit(base), F.col("path")) + F.lit(len(base)))
    listing = files.select(name.alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("last_modified"))
    return listing if start_after is None else listing.where(F.col("name") > start_after)


def list_prefixes(listing: DataFrame) -> DataFrame:
    """Immediate sub-folders of a listing."""
    parts = F.split("name", "/")
    return listing.where(F.size(parts) > 1).select(parts[0].alias("prefix")).distinct()


def read_heads(spark: SparkSession, root: str, length: int = 65536) -> DataFrame:
    """(path, head string): the first bytes of each file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select("path", F.decode(F.substring("content", 1, length), "UTF-8").alias("head"))


def read_journal(spark: SparkSession, root: str, cursors: DataFrame | None = None, own: str | None = None) -> DataFrame:
    """(device, segment, id) of done-journal segments <root>/<device>/<sequence>.txt.gz.

    Torn segments are skipped. cursors (device, cursor) leaves out segments already seen; `own` a device's own.
    """
    lines = spark.read.option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true").text(root).select("value", F.col("_metadata.file_path").alias("path"))
    return _journal(lines, cursors, own)


def _journal(lines: DataFrame, cursors: DataFrame | None, own: str | None) -> DataFrame:
    parts = F.split("path", "/")
    rows = lines.select(F.element_at(parts, -2).alias("device"), F.substring_index(F.element_at(parts, -1), ".", 1).alias("segment"), F.trim("value").alias("id")).where("id <> ''")
    if own is not None:
        rows = rows.where(F.col("device") != own)
    if cursors is not None:
        rows = rows.join(cursors, "device", "left").where("cursor is null or segment > cursor").drop("cursor")
    return rows


def read_json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row for each JSON file (markers, plans, worker states, metadata); unreadable files are left out."""
    texts = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    return _parsed(texts, schema).where("_good").select("_r.*").drop("_corrupt")


def fetched_pdf(files: DataFrame) -> DataFrame:
    """(path, pdf_bytes, pdf_sha256, is_pdf) of staged downloads read as binary files."""
    head: Column = F.coalesce(F.substring("content", 1, 5) == F.lit(b"%PDF-"), F.lit(False))
    return files.select("path", F.length("content").alias("pdf_bytes"), F.sha2("content", 256).alias("pdf_sha256"), head.alias("is_pdf"))
