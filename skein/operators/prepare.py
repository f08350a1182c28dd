"""From snapshot records to manifest rows: normalise, resolve versions, scope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import ids, text



def resolve_versions(versions: Column) -> Column:
    """struct<latest, first_date, latest_date, n>: versions in numeric order, ties in input order."""
    v = F.coalesce(versions, F.array().cast("array<struct<version:string,created:string>>"))
    keyed = F.transform(v, lambda x, i: F.struct(ids.version_number(x["version"]).alias("n"), i.alias("at"), x["version"].alias("version"), text.rfc2822_date(x["created"]).alias("day")))
    ordered = F.array_sort(keyed)
    last = F.try_element_at(ordered, F.lit(-1))
    return F.struct(
        F.coalesce(last["version"], F.lit("v1")).alias("latest"), F.try_element_at(ordered, F.lit(1))["day"].alias("first_date"), last["day"].alias("latest_date"), F.size(v).alias("n")
    )


def parse_records(records: DataFrame) -> DataFrame:
    """Eleven normalised columns from snapshot records."""
    v = F.col("_v")
    categories = text.split_categories(F.col("categories"))
    rows = records.withColumn("_v", resolve_versions(F.col("versions")))
    return rows.select(
        F.coalesce("id", F.lit("")).alias("arxiv_id"), v["latest"].alias("version"), text.collapse_spaces(F.coalesce("title", F.lit(""))).alias("title"),
        text.author_names(F.col("authors_parsed")).alias("authors"), categories.alias("categories"), F.try_element_at(categories, F.lit(1)).alias("primary_category"),
        F.nullif("doi", F.lit("")).alias("doi"), v["first_date"].alias("date_released"), F.coalesce(v["latest_date"], F.try_to_date(F.substring("update_date", 1, 10))).alias("date_updated"),
        v["n"].alias("n_versions"), F.col("comments"),
    )


def to_rows(parsed: DataFrame) -> DataFrame:
    """Manifest columns: authors as JSON, categories joined, shard and bucket derived."""
    return parsed.select(
        *"arxiv_id version title primary_category doi date_released date_updated".split(), ids.shard_for(F.col("arxiv_id")).alias("shard"),
        F.to_json("authors").alias("authors"), F.array_join("categories", " ").alias("categories"), ids.bucket_for(F.col("arxiv_id")).alias("bucket"),
    )


def in_scope(rows: DataFrame, categories: list[str] | None = None, primary_only: bool = False, date_from: str | None = None, date_to: str | None = None, max_papers: int | None = None) -> DataFrame:
    """Rows with an id, any wanted category (or the primary one) and a release date in the window; a cap takes the first by id."""
    kept = rows.where("arxiv_id <> ''").where(text.in_window(F.col("date_released"), date_from, date_to))
    if categories:
        wanted = F.array(*map(F.lit, categories))
        kept = kept.where(F.col("primary_category").isin(*categories) if primary_only else F.arrays_overlap("categories", wanted))
    return kept if max_papers is None else kept.orderBy("arxiv_id").limit(max_papers)
