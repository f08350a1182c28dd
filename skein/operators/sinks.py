"""Sinks: artefacts by shard, journals in segments, CSV, caches, relational staging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skein.functions import ids
from skein.functions import markdown as md

METADATA = tuple("arxiv_id version title authors categories primary_category doi date_released date_updated n_pages n_tables n_chars converter source_url".split())


def metadata(converted: DataFrame, base_url: str = "https://example.org") -> DataFrame:
    """The 14 metadata columns in their fixed order."""
    return converted.withColumn("source_url", F.concat(F.lit(base_url.rstrip("/") + "/abs/"), F.col("arxiv_id"), F.col("version"))).select(*METADATA)


def flatten(meta: DataFrame) -> DataFrame:
    """15 columns for a relational table: empty texts and arrays are null, the whole record goes along as JSON."""
    kinds = dict(meta.dtypes)
    cleaned = [(F.when(F.size(c) > 0, F.col(c)) if kinds[c].startswith("array") else F.nullif(c, F.lit("")) if kinds[c] == "string" else F.col(c)).alias(c) for c in METADATA]
    return meta.select(*cleaned, F.to_json(F.struct(*METADATA)).alias("raw"))


def merge_staged(target: DataFrame, staged: DataFrame, key: str = "arxiv_id") -> DataFrame:
    """Insert or update by key: staged rows win."""
    new = staged.dropDuplicates([key])
    return target.join(new.select(key), key, "left_anti").select(*target.columns).unionByName(new.select(*target.columns))


def write_artefacts(converted: DataFrame, tables: DataFrame, root: str) -> None:
    """Markdown, tables (for papers that have some) and metadata, one folder for each shard, by Spark's commit protocol."""
    shard = ids.shard_for(F.col("arxiv_id"))
    bodies = converted.select(shard.alias("shard"), "arxiv_id", md.link_markers(F.col("body"), ids.relative_tables_link(F.col("arxiv_id")), F.col("n_tables") > 0).alias("body"))
    bodies.write.mode("overwrite").partitionBy("shard").parquet(f"{root}/md")
    block = md.table_block(F.col("index"), F.col("caption"), F.lit(1), F.col("columns"), F.col("n_rows"), F.col("markdown"))
    sections = tables.groupBy("arxiv_id").agg(F.sort_array(F.collect_list(F.struct("index", block.alias("section")))).alias("s"))
    sections.select(shard.alias("shard"), "arxiv_id", F.array_join(F.transform("s", lambda x: x["section"]), "\n\n").alias("body")).write.mode("overwrite").partitionBy("shard").parquet(f"{root}/tables")
    metadata(converted).withColumn("shard", shard).write.mode("overwrite").partitionBy("shard").json(f"{root}/meta")


def journal_segments(done: DataFrame, device: str, first: int = 0, size: int = 200_000) -> DataFrame:
    """(device, seq, arxiv_id): ids in segments of about `size`, numbered from first, without a global sort.

    Ids are range-partitioned; every range makes its own segments, numbered by the rows before it.
    """
    n = done.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ranged = done.select("arxiv_id").repartitionByRange(int(n), "arxiv_id").withColumn("r", F.spark_partition_id())
    place = F.row_number().over(W.partitionBy("r").orderBy("arxiv_id")) - 1
    cut = ranged.withColumn("part", F.floor(place / size))
    numbers = F.dense_rank().over(W.orderBy("r", "part")) - 1 + first
    seq = cut.select("r", "part").distinct().withColumn("seq", numbers)
    return cut.join(seq, ["r", "part"]).select(F.lit(device).alias("device"), F.lpad(F.col("seq").cast("string"), 10, "0").alias("seq"), "arxiv_id")


def write_journal(segments: DataFrame, root: str) -> None:
    segments.select("device", "seq", F.col("arxiv_id").alias("value")).write.mode("append").partitionBy("device", "seq").option("compression", "gzip").text(root)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def move_plan(local: DataFrame, remote: DataFrame, skip_existing: bool = True, limit: int | None = None) -> DataFrame:
    """What moving a local corpus would do: (name, size, outcome)."""
    have = remote.select("name", F.lit(True).alias("there"))
    rows = local.join(have, "name", "left").withColumn("outcome", F.when(F.col("there") & F.lit(skip_existing), "skipped").otherwise("moved")).drop("there")
    return rows if limit is None else rows.orderBy("name").limit(limit)


def move_report(plan: DataFrame) -> DataFrame:
    return plan.groupBy("outcome").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))


def remove(listing: DataFrame, tombstones: DataFrame) -> DataFrame:
    return listing.join(tombstones.select("name"), "name", "left_anti")


def write_marker(spark: SparkSession, root: str, device: str, part: tuple[int, int] | None, state: str, at: str) -> None:
    """A device's marker: its range, the state of its run and when it was written, as one JSON file of its folder."""
    low, high = part or (None, None)
    row = spark.createDataFrame([(device, low, high, state, at)], "device string, lo int, hi int, state string, updated_at string")
    shaped = row.select("device", F.when(F.col("lo").isNotNull(), F.array("lo", "hi")).alias("range"), "updated_at", F.struct("state").alias("run"))
    shaped.coalesce(1).write.mode("overwrite").json(f"{root}/{device}")


def cached(frames: dict[str, DataFrame], source_files: DataFrame, root: str) -> dict[str, DataFrame]:
    """Aggregates read back from CSV files, written anew where the sources' size has changed or a file is missing."""
    spark = source_files.sparkSession

    def there(path: str) -> bool:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)

    stamp = f"{root}/_source"
    had = spark.read.schema("bytes long").csv(stamp).first()[0] if there(stamp) else None
    if cache_is_stale(source_files, had, not all(there(f"{root}/{k}/_SUCCESS") for k in frames)):
        for k, df in frames.items():
            write_csv(df, f"{root}/{k}")
        source_files.agg(F.sum("size").alias("bytes")).write.mode("overwrite").csv(stamp)
    return {k: spark.read.schema(df.schema).option("header", True).csv(f"{root}/{k}") for k, df in frames.items()}


def cache_is_stale(source_files: DataFrame, cached_bytes: int | None, missing: bool) -> bool:
    """A cache of aggregates is rebuilt when its source's size changed or a file is missing."""
    now = source_files.agg(F.sum("size")).first()[0]
    return missing or cached_bytes is None or now != cached_bytes
