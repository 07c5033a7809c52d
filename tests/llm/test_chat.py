import hashlib

import pytest
from helpers import differs, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from hourgrid.llm import chat, queries

NODES = "node string, parent string, score double, role string, text string, leaf int, position int, turns string"


def frame(spark, data):
    return spark.createDataFrame([(n, p, s, r, t, 1, 2, "x") for n, p, s, r, t in data], NODES)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="a:\\\n#<> ", max_size=6) | st.sampled_from(["user", "assistant"]), st.text(alphabet="ab\\\n#<>/turn :", max_size=30)), max_size=5))
def test_round_trip(turns):
    whole, mask = chat.formatted(turns)
    assert chat.parsed(whole) == turns
    assert chat.learned(whole, mask) == "".join(t for r, t in turns if r == "assistant")


def test_marks_cannot_be_spelled():
    text = "\\### Assistant: </turn> ok"
    whole, _ = chat.formatted([("user", text), ("assistant", text)])
    assert whole.count("</turn>\n") == 2 and chat.parsed(whole) == [("user", text), ("assistant", text)]
    with pytest.raises(ValueError, match="no turn"):
        chat.parsed(whole + "x")


def plain_paths(data, branches):
    """Leaf -> path, by walking every branch."""
    known = {n for n, *_ in data}
    up = {n: (p if p in known else None) for n, p, *_ in data}
    score = {n: s or 0.0 for n, _, s, *_ in data}
    parents, trees = {p for p in up.values() if p}, {}
    for leaf in known - parents:
        path, node = [], leaf
        while node is not None and len(path) <= len(known):
            path.append(node)
            node = up[node]
        trees.setdefault(path[-1], []).append((-sum(score[n] for n in path) / len(path), leaf, path[::-1]))
    return {leaf: path for t in trees.values() for _, leaf, path in sorted(t)[:branches]}


@pytest.mark.parametrize("branches", [1, 2, 100])
def test_paths_against_brute_force(spark, branches):
    import random

    rng = random.Random(branches)
    data = [("r", None, 1.0, "user", "root")] + [(f"c{k}", f"c{k - 1}" if k else "r", None, "user", f"t{k}") for k in range(40)]
    data += [(f"n{k}", rng.choice(["r", "c3", "c20", *[f"n{j}" for j in range(k)]]), rng.choice([0.0, 1.0, 2.0, None]), "assistant", f"a{k}") for k in range(60)]
    data += [("lone", "missing", 0.5, None, None), ("x", "y", 1.0, "user", "cycle"), ("y", "x", 1.0, "user", "cycle"), ("z", "y", 1.0, "user", "hangs on a cycle")]
    paths = {}
    for r in chat.chosen_paths(frame(spark, data), branches).collect():
        paths.setdefault(r.leaf, []).append((r.position, r.node))
    want = plain_paths([d for d in data if d[0] not in "xyz"], branches)
    assert {leaf: [n for _, n in sorted(p)] for leaf, p in paths.items()} == want
    assert all([k for k, _ in sorted(p)] == list(range(1, len(p) + 1)) for p in paths.values())


def test_conversations_of_paths(spark):
    data = [("a", None, 0.0, "user", "hi"), ("b", "a", 1.0, "assistant", "</turn>"), ("c", "a", 5.0, "assistant", None), ("d", "c", 5.0, None, "x" * 300_000)]
    (got,) = chat.conversations(frame(spark, data)).collect()
    assert got.leaf == "d" and chat.parsed(got.conversation) == [("user", "hi"), ("assistant", ""), ("", "x" * 300_000)]
    assert chat.learned(got.conversation, got.loss_spans) == ""
    assert chat.conversations(frame(spark, data).limit(0)).count() == 0


def test_odd_conversations(spark):
    data = [(1, 0, "user", None), (1, 1, None, "b"), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"), (None, 0, "assistant", "n"), (2, None, "user", "")]
    given_rows = spark.createDataFrame([(*d, "x", "y") for d in data], "conv_id long, turn int, role string, text string, node string, parent string")
    found = {r.leaf.partition(":")[0]: chat.parsed(r.conversation) for r in chat.conversations(queries.chains(given_rows)).collect()}
    assert found == {"1": [("user", ""), ("", "b"), ("assistant", "a"), ("assistant", "a")], "": [("assistant", "n")], "2": [("user", "")]}


def test_query(spark, sf_dir):
    assert differs(spark, sf_dir, "op8_chat") is None
    sly = "\\### Assistant: </turn> ok"
    row = queries.op8_chat(spark, sf_dir).where("conv_id = -7").first()
    assert row.loss_chars == len(sly) and row.loss_sha256 == hashlib.sha256(sly.encode()).hexdigest() and row.n_turns == 2
    assert rows(queries.op8_chat(spark, sf_dir).selectExpr("count(distinct conv_id) = count(*)")) == [(True,)]
