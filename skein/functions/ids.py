"""Identifiers: safe names, shards, buckets, versions, artefact and object names, references."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 256
KIND_SUFFIX = {"md": ".md", "tables": "_tables.md", "meta": ".json"}


def safe_id(paper: Column) -> Column:
    return F.replace(paper, F.lit("/"), F.lit("_"))


def shard_for(paper: Column) -> Column:
    """yymm of a new or an old identifier if its month is 01 to 12, else misc."""
    new = F.regexp_extract(paper, r"^([0-9]{4})\.[0-9]{4,5}$", 1)
    old = F.regexp_extract(paper, r"^[a-zA-Z.\-]+/([0-9]{4})[0-9]{3}$", 1)
    yymm = F.when(new != "", new).otherwise(old)
    return F.when((yymm != "") & F.substring(yymm, 3, 2).between("01", "12"), yymm).otherwise("misc")


def bucket_for(paper: Column) -> Column:
    """crc32 of the UTF-8 bytes modulo 256."""
    return F.pmod(F.crc32(F.encode(paper, "UTF-8")), F.lit(BUCKETS)).cast("int")


def version_number(version: Column) -> Column:
    """12 for v12; 0 for null and anything else."""
    return F.coalesce(F.regexp_replace(version, "^v+", "").try_cast("int"), F.lit(0))


def artefact_path(kind: str, root: Column, paper: Column) -> Column:
    """root/kind/shard/name for one of the three artefact kinds."""
    return F.concat_ws("/", root, F.lit(kind), shard_for(paper), F.concat(safe_id(paper), F.lit(KIND_SUFFIX[kind])))


def object_name(kind: str, paper: Column, prefix: str = "") -> Column:
    parts = [F.lit(kind), shard_for(paper), F.concat(safe_id(paper), F.lit(KIND_SUFFIX[kind]))]
    return F.concat_ws("/", *([F.lit(prefix.strip("/"))] if prefix.strip("/") else []), *parts)


def relative_tables_link(paper: Column) -> Column:
    return F.concat(F.lit("../../tables/"), shard_for(paper), F.lit("/"), safe_id(paper), F.lit("_tables.md"))


def id_candidates(name: Column, kind: str = "md", prefix: str = "") -> Column:
    """Both readings of an object's name: an underscore may stand for a slash; null for names of another kind."""
    lead = (prefix.strip("/") + "/" if prefix.strip("/") else "") + kind + "/"
    stem = F.regexp_replace(F.element_at(F.split(name, "/"), -1), KIND_SUFFIX[kind].replace(".", r"\.") + "$", "")
    slashed = F.regexp_replace(stem, "^([^_]*)_", "$1/")
    ok = name.startswith(lead) & name.endswith(KIND_SUFFIX[kind]) & (F.size(F.split(F.substr(name, F.lit(len(lead) + 1)), "/")) == 2) & (stem != "")
    return F.when(ok, F.when(stem.contains("_"), F.array(stem, slashed)).otherwise(F.array(stem)))


def parse_reference(text: Column) -> Column:
    """struct<id, version> of a URL, an arXiv: reference or a bare identifier; nulls if none is found."""
    t = F.regexp_replace(F.trim(text), r"\.pdf$", "")
    core = r"([a-z\-]+(?:\.[A-Z]+)?/[0-9]{7}|[0-9]{4}\.[0-9]{4,5})(v[0-9]+)?"
    pattern = r"^(?:https?://[^/]+/(?:abs|pdf|html)/|(?i:arxiv:)\s*)?" + core + "$"
    return F.struct(F.nullif(F.regexp_extract(t, pattern, 1), F.lit("")).alias("id"), F.nullif(F.regexp_extract(t, pattern, 2), F.lit("")).alias("version"))


def archive_of(category: Column) -> Column:
    return F.split(category, r"\.")[0]


def device_name(name: Column) -> Column:
    return F.substring(F.regexp_replace(name, r"[^\w.\-]", "-"), 1, 64)
