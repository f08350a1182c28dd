"""Tables lifted out of Markdown, captions, equations: lines as rows, windows over a document's lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skein.functions import markdown as md
from skein.functions.text import collapse_spaces


def lines(docs: DataFrame, key: str = "doc", body: str = "body") -> DataFrame:
    """(key, pos, line)"""
    return docs.select(key, F.posexplode(F.split(body, "\n")).alias("pos", "line"))


def mark_blocks(rows: DataFrame, key: str = "doc") -> DataFrame:
    """rows with block: null outside tables, else the position of the table's first line.

    A table starts at the first line of a run of pipe lines that a separator follows, and ends with the run.
    """
    w = W.partitionBy(key).orderBy("pos")
    marked = rows.withColumn("pipe", F.col("line").rlike(md.PIPE_LINE))
    follows = F.coalesce(F.lead(md.is_separator(F.col("line"))).over(w) & F.lead("pipe").over(w), F.lit(False))
    marked = marked.withColumn("start", F.col("pipe") & follows).withColumn("run", F.sum(F.when(F.col("pipe"), 0).otherwise(1)).over(w))
    first = F.min(F.when(F.col("start"), F.col("pos"))).over(W.partitionBy(key, "run"))
    return marked.withColumn("block", F.when(F.col("pipe") & (F.col("pos") >= first), first)).drop("start", "run", "pipe")


def captions(marked: DataFrame, key: str = "doc", reach: int = 4) -> DataFrame:
    """(key, block, caption): the nearest line that looks like a caption, above before below at the same offset.

    Offsets k = 1 to reach probe the line k above the first and k - 1 below the last one; pipe lines never count.
    """
    edges = marked.where("block is not null").groupBy(key, "block").agg(F.min("pos").alias("start"), (F.max("pos") + 1).alias("end"))
    probes = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(reach)), lambda k: F.array(F.struct(k.alias("k"), F.lit(0).alias("side"), (F.col("start") - k).alias("at")), F.struct(k.alias("k"), F.lit(1).alias("side"), (F.col("end") + k - 1).alias("at")))))
    asked = edges.select(key, "block", F.explode(probes).alias("p")).select(key, "block", "p.k", "p.side", F.col("p.at").alias("pos"))
    said = marked.where(F.col("block").isNull() & (F.col("line").rlike(md.TABLE_CAPTION) | F.col("line").rlike(md.CODE_CAPTION)) & ~F.col("line").rlike(md.PIPE_LINE)).select(key, "pos", "line")
    best = asked.join(said, [key, "pos"]).groupBy(key, "block").agg(F.min(F.struct("k", "side", collapse_spaces(F.col("line")).alias("caption"))).alias("b"))
    return best.select(key, "block", F.col("b.caption").alias("caption"))


def lift_tables(docs: DataFrame, key: str = "doc", body: str = "body", max_columns: int = md.MAX_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """(tables, bodies): one row for each kept table, numbered in order, and each text with markers in their place.

    Degenerate blocks leave neither table nor marker, so numbers have no gap; pseudocode stays in the
    text as a fenced block. n_rows leaves out the head, but counts all rows of pseudocode.
    """
    marked = mark_blocks(lines(docs, key, body), key)
    cells = F.when(~md.is_separator(F.col("line")), md.split_row(F.col("line")))
    blocks = marked.where("block is not null").groupBy(key, "block").agg(F.sort_array(F.collect_list(F.struct("pos", cells.alias("cells")))).alias("r"))
    rows = F.filter(F.transform("r", lambda x: x["cells"]), lambda c: c.isNotNull() & F.exists(c, lambda v: v != ""))
    blocks = blocks.select(key, "block", rows.alias("rows")).join(captions(marked, key), [key, "block"], "left").withColumn("caption", F.coalesce("caption", F.lit("")))
    code = md.looks_like_pseudocode(F.col("rows"), F.col("caption"))
    kind = F.when(F.size("rows") == 0, "none").when(code, "pseudocode").when(md.is_degenerate(F.col("rows"), max_columns), "none").otherwise("table")
    kept = blocks.withColumn("kind", kind)
    number = F.row_number().over(W.partitionBy(key, "kind").orderBy("block"))
    kept = kept.withColumn("index", F.when(F.col("kind") == "table", number))
    tables = kept.where("kind = 'table'").select(
        key, "index", "block", (F.size("rows") - 1).alias("n_rows"), F.array_max(F.transform("rows", F.size)).alias("n_cols"), md.render_rows(F.col("rows")).alias("markdown"), "caption", F.col("rows")[0].alias("columns")
    )
    text = F.when(F.col("kind") == "table", F.format_string("[[TABLE:%d]]", "index")).when(F.col("kind") == "pseudocode", md.render_pseudocode(F.col("rows")))
    replaced = kept.select(key, F.col("block").alias("pos"), text.alias("line"))
    left = marked.where("block is null").select(key, "pos", "line").unionByName(replaced.where("line is not null"))
    bodies = left.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n").alias("body"))
    return tables, bodies


def mark_equations(docs: DataFrame, key: str = "doc", body: str = "body") -> DataFrame:
    """Texts with display equations in $$, outside fences; a fence line toggles first."""
    fence: Column = F.trim("line").startswith("```")
    inside = F.pmod(F.sum(F.when(fence, 1).otherwise(0)).over(W.partitionBy(key).orderBy("pos").rowsBetween(W.unboundedPreceding, 0)), F.lit(2)) == 1
    shown = F.when(~inside & ~fence & md.looks_like_display_equation(F.col("line")), F.concat(F.lit("$$ "), F.trim("line"), F.lit(" $$"))).otherwise(F.col("line"))
    out = lines(docs, key, body).withColumn("line", shown)
    return out.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n").alias("body"))


def low_text(n_pages: Column, n_chars: Column, least: int = 100) -> Column:
    return F.when(n_pages > 0, n_chars / n_pages < least).otherwise(False)


def accept_fallback(first_chars: Column, retry_chars: Column, retry_tables: Column) -> Column:
    return (retry_tables > 0) & ((first_chars == 0) | (retry_chars >= 0.5 * first_chars))
