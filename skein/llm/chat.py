"""Chat formatting: root-to-leaf paths of reply trees, ranked by score, each as one conversation."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from skein.llm.common import map_arrow, written


@dataclass(frozen=True)
class ChatTemplate:
    """Marks of a turn and the strings that texts may not show as they are.

    A turn is start + role + newline + text + end. In roles and texts a backslash is doubled, and a
    control string gets a backslash after its first character, so none is left whole; in roles a
    newline becomes backslash and n. Reading back undoes this exactly.
    """

    start: str = "<|turn|>"
    end: str = "<|end|>\n"
    control: tuple[str, ...] = ("<|turn|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
    learned: tuple[str, ...] = ("assistant",)

    def escape(self, text: str) -> str:
        tails = "|".join(re.escape(c[1:]) for c in self.control)
        firsts = re.escape("".join(sorted({c[0] for c in self.control})))
        return re.sub(rf"([{firsts}])(?={tails})", r"\1\\", text.replace("\\", "\\\\"))

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)

    def format(self, turns: list[tuple[str | None, str | None]]) -> tuple[str, list[tuple[int, int]]]:
        """The conversation, and (start, length) in code points of each text under the loss mask."""
        out, spans, at = [], [], 0
        for role, text in turns:
            head = self.start + self.escape(role or "").replace("\n", "\\n") + "\n"
            body = self.escape(text or "")
            if (role or "") in self.learned:
                spans.append((at + len(head), len(body)))
            out += [head, body, self.end]
            at += len(head) + len(body) + len(self.end)
        return "".join(out), spans

    def parse(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) of each turn."""
        turns = []
        for part in formatted.split(self.end)[:-1]:
            head, _, body = part.removeprefix(self.start).partition("\n")
            role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], head)
            turns.append((role, self.unescape(body)))
        return turns

    def masked(self, formatted: str, spans: list[tuple[int, int]]) -> str:
        """All text under the loss mask, unescaped."""
        return "".join(self.unescape(formatted[a : a + n]) for a, n in spans)


def paths(messages: DataFrame, top: int | None = None) -> DataFrame:
    """Root-to-leaf paths of reply trees: (tree, leaf, score double, rank int, node, pos int).

    messages has tree, node, parent, role, text and score; node is unique in its tree. Self-joins
    over jump tables of 1, 2, 4, ... steps enumerate each leaf's ancestors, so a thread of n turns
    takes log2(n) rounds. Branches are ranked in their tree by the sum of their scores (null: zero),
    ties to the smaller leaf; `top` keeps the best branches of each tree (a report limit; None keeps
    all). pos counts from the leaf, 0. A parent that isn't in the table makes a root; messages on a
    cycle, or below one, are on no path. Null trees form one tree; null nodes are on no path.
    """
    m = messages.where("node is not null").select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    up = m.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    step = m.join(up, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("n"))).select("tree", "node", F.col("n").alias("anc"))
    step = written(step, "chat-step")
    parents = step.select(F.col("tree").alias("t"), F.col("anc").alias("n")).distinct()
    leaves = m.join(parents, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")), "left_anti")
    walk = written(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).alias("pos")), "chat-walk")
    jump, size, limit = step, 1, m.count()
    while size <= limit:
        j = jump.select(F.col("tree").alias("t"), F.col("node").alias("n"), "anc")
        new = walk.join(j, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))).select("tree", "leaf", F.col("anc").alias("node"), (F.col("pos") + size).alias("pos"))
        new = written(new, "chat-walk")
        if new.isEmpty():
            break
        walk = walk.unionByName(new)
        k = jump.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("anc").alias("far"))
        jump = written(jump.join(k, F.col("tree").eqNullSafe(F.col("t")) & (F.col("anc") == F.col("n"))).select("tree", "node", F.col("far").alias("anc")), "chat-step")
        size *= 2
    at = m.select(F.col("tree").alias("t"), F.col("node").alias("n"), "score")
    full = walk.join(at, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))).select("tree", "leaf", "node", "pos", "score")
    child = step.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.lit(1).alias("child"))
    full = full.join(child, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")), "left").select("tree", "leaf", "node", "pos", "score", "child")
    branch = full.groupBy("tree", "leaf").agg(F.sum("score").alias("score"), F.max(F.col("child").isNull()).alias("rooted")).where("rooted").drop("rooted")
    branch = branch.withColumn("rank", F.row_number().over(W.partitionBy("tree").orderBy(F.desc("score"), "leaf")))
    if top is not None:
        branch = branch.where(F.col("rank") <= top)
    b = branch.select(F.col("tree").alias("t"), F.col("leaf").alias("l"), F.col("score").alias("total"), "rank")
    return full.join(b, F.col("tree").eqNullSafe(F.col("t")) & (F.col("leaf") == F.col("l"))).select("tree", "leaf", F.col("total").alias("score"), "rank", "node", "pos")


def format_branches(messages: DataFrame, template: ChatTemplate | None = None, top: int | None = None) -> DataFrame:
    """One conversation for each chosen path: (tree, leaf, rank, score, formatted string, loss_spans array<struct<start,length>>).

    Null roles and texts count as empty; see paths() for the rest. No rows give no rows.
    """
    template, messages = template or ChatTemplate(), written(messages, "chat-messages")
    p = paths(messages, top)
    said = messages.select(F.col("tree").alias("t"), F.col("node").alias("n"), "role", "text")
    turns = p.join(said, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")))
    grouped = turns.groupBy("tree", "leaf", "rank", "score").agg(F.sort_array(F.collect_list(F.struct("pos", "role", "text")), False).alias("turns"))
    kinds = dict(grouped.dtypes)
    out = f"tree {kinds['tree']}, leaf {kinds['leaf']}, rank int, score double, formatted string, loss_spans array<struct<start:long,length:long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        for b in batches:
            texts, spans = [], []
            for turn in b.column(4):
                text, own = template.format([(t["role"], t["text"]) for t in turn.as_py()])
                texts.append(text)
                spans.append([{"start": a, "length": n} for a, n in own])
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(texts, pa.string()), pa.array(spans, spans_type)], ["tree", "leaf", "rank", "score", "formatted", "loss_spans"])

    return map_arrow(grouped, run, out, "chat")


def from_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Linear conversations as reply trees: each row answers the one before it, ties by role and text, null turns first."""
    order = W.partitionBy("tree").orderBy("turn", "role", "text")
    rows = turns.select(F.col(conv_id).cast("long").alias("tree"), F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("node", F.row_number().over(order).cast("long")).select("tree", "node", (F.col("node") - 1).alias("parent"), F.coalesce("role", F.lit("")).alias("role"), "text", F.lit(0.0).alias("score"))
