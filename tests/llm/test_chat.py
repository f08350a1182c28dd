import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from skein.llm import chat

T = chat.ChatTemplate()
PIECES = st.lists(st.sampled_from([*T.control, "\\", "<", "[", "|", "/", "\n", "a", "é", "end|>", "n"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), PIECES, st.just("assistant")), st.one_of(st.none(), PIECES)), max_size=5))
def test_format_is_reversible_and_shows_no_control_string(turns):
    text, spans = T.format(turns)
    assert T.parse(text) == [(r or "", t or "") for r, t in turns]
    assert T.masked(text, spans) == "".join(t or "" for r, t in turns if r == "assistant")
    for _, t in turns:
        assert not any(c in T.escape(t or "") for c in T.control)


def slow(rows):
    kids = {}
    nodes = {(t, n): (p, s or 0.0) for t, n, p, _, _, s in rows if n is not None}
    for (t, n), (p, _) in nodes.items():
        kids.setdefault((t, p), []).append(n)
    out = []
    for t, n in nodes:
        if (t, n) in kids:
            continue
        path, seen, cur = [], set(), n
        while cur is not None and (t, cur) in nodes and cur not in seen:
            seen.add(cur)
            path.append(cur)
            cur = nodes[t, cur][0]
        if cur is not None and cur in seen:
            continue  # below a cycle
        out.append((t, n, tuple(reversed(path)), sum(nodes[t, x][1] for x in path)))
    return out


def test_paths_of_trees_with_orphans_and_cycles(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "a", 2.0), (1, 3, 1, "assistant", "b", 5.0), (1, 4, 3, "user", "c", -1.0), (1, 5, 4, "assistant", "d", None), (1, 6, 4, "assistant", "e", 0.5)]
    rows += [(None, 1, None, "user", None, 1.0), (None, 2, 1, None, "x", 1.0), (2, 7, 99, "user", "orphan", 0.0), (3, 1, 2, "u", "x", 0.0), (3, 2, 1, "u", "x", 0.0), (3, 4, 2, "u", "x", 0.0), (4, None, None, "u", "x", 0.0)]
    rows += [(9, i, i - 1 if i else None, "user", str(i), 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    got = {}
    for r in chat.paths(df).collect():
        got.setdefault((r.tree, r.leaf, r.score), []).append((r.pos, r.node))
    assert sorted(((t, leaf, tuple(n for _, n in sorted(p, reverse=True)), s) for (t, leaf, s), p in got.items()), key=str) == sorted(slow(rows), key=str)
    best = chat.format_branches(df, top=1).where("tree = 1").collect()
    assert [(r.leaf, r["rank"], T.parse(r.formatted)) for r in best] == [(6, 1, [("user", "q"), ("assistant", "b"), ("user", "c"), ("assistant", "e")])]
    assert chat.format_branches(df.limit(0)).collect() == []


def test_turns_with_ties_and_nulls(spark):
    rows = [(1, 1, "assistant", "b", 0), (1, 1, "assistant", "a", 0), (1, None, "user", None, 0), (None, 0, "user", "x", 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, score int")
    got = {r.tree: T.parse(r.formatted) for r in chat.format_branches(chat.from_turns(df)).collect()}
    assert got == {1: [("user", ""), ("assistant", "a"), ("assistant", "b")], None: [("user", "x")]}


def test_query_on_the_whole_table(spark, sf):
    from skein.llm.queries import op3_chat_formatting

    conv = {}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect():
        conv.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    said = "</s>[INST] ok [/INST]"
    conv[-1] = [("user", said), ("assistant", said)]
    for r in op3_chat_formatting(spark, sf).collect():
        turns = conv.pop(r.conv_id)
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256, r.formatted_chars) == (len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(T.format(turns)[0]))
    assert not conv


def test_very_long_texts_come_back(spark):
    said = "a </s> b\\ \n" * 200_000
    df = spark.createDataFrame([(1, 0, "user", said), (1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    (r,) = chat.format_branches(chat.from_turns(df)).collect()
    assert T.parse(r.formatted) == [("user", said), ("assistant", said)] and T.masked(r.formatted, [(s.start, s.length) for s in r.loss_spans]) == said
