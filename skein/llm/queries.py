"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import chat, decontaminate, fitting, licences, mixing, quality, simhash, suffixes, tokens, topk, toxicity
from skein.llm.common import fresh_path, map_arrow, written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


_OP2_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings
  where vec_id is not null and embedding is not null and list_count(embedding) = len(embedding) and list_bool_and(list_transform(embedding, lambda x: isfinite(x)))),
s as (select q.vec_id as query_id, c.vec_id as vec_id, list_dot_product(q.v, c.v)::bigint as score
  from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id)
select query_id, rank::integer as rank, vec_id, score from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 20"""


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    table = _table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    template = chat.ChatTemplate()
    formatted = written(chat.format_branches(chat.from_turns(table.unionByName(own)), template), "chat")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r in b.to_pylist():
                turns = template.parse(r["formatted"])
                loss = template.masked(r["formatted"], [(s["start"], s["length"]) for s in r["loss_spans"]])
                whole = "".join(f"{role}\n{text}\n" for role, text in turns)
                rows.append((r["tree"], len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(r["formatted"])))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return map_arrow(formatted.select("tree", "formatted", "loss_spans"), read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long", "chat")


def _op3_sql() -> str:
    t = chat.ChatTemplate()
    marks = "array[" + ", ".join(f"'{c}'" for c in t.control) + "]"

    def escapes(x: str) -> str:  # added by escaping: one for each backslash and control string
        return f"(length({x}) - length(replace({x}, chr(92), '')) + list_sum(list_transform({marks}, lambda c: (length({x}) - length(replace({x}, c, ''))) // length(c))))"

    return f"""
with own(conv_id, turn, role, text) as (values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from (select conv_id, turn, role, text from conversations union all select * from own))
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum({len(t.start) + 1 + len(t.end)} + length(role) + (length(role) - length(replace(role, chr(10), ''))) + {escapes("role")} + length(text) + {escapes("text")})::bigint as formatted_chars
from t group by conv_id"""


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", fitting.held_out(4, 2).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_passage_words")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    tokens.write_tokens(_table(spark, sf_dir, "documents"), path, str(public_tokenizers.path("byte_bpe_50k.json")))
    return tokens.read_digests(spark, path)


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", fitting.held_out(5, 0).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


#: Target weights of the sources; one without a weight takes the least of them.
WEIGHTS: dict[str | None, float] = {f"src{i}": 1 / (1 + i) for i in range(20)}


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), WEIGHTS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_exact_top_k": op2_exact_top_k,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_token_ids": op7_token_ids,
    "op8_licence_scan": op8_licence_scan,
    "op9_toxicity": op9_toxicity,
    "op10_mix_sources": op10_mix_sources,
}

ORACLES: dict[str, str] = {
    "op2_exact_top_k": _OP2_SQL,
    "op3_chat_formatting": _op3_sql(),
    "op8_licence_scan": licences.oracle_sql(),
}
