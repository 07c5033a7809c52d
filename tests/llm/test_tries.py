import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from helpers import differs

from hourgrid.llm import queries, tries

EMPTY = hashlib.sha256(b"").hexdigest()


def expected(conversations):
    """Nodes of the trie over {identifier: [(role, text), ...]}, each subtree walked in full."""
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
        ends[tuple(turns)].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def walk(node):
        saved, leaves, todo = 0, 0, [node]
        while todo:
            at = todo.pop()
            saved += (len(members[at]) - 1) * (len(at[-1][1]) if at else 0)
            leaves += not children[at]
            todo += children[at]
        return leaves, saved

    out = []
    for node, convs in members.items():
        leaves, saved = walk(node)
        listed = ",".join(map(str, sorted(ends[node]))) if node in ends else ""
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children[node]), leaves, saved, hashlib.sha256(listed.encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(3)


def trie(spark, rows):
    turns = tries.ordered_turns(frame(spark, rows))
    return nodes(tries.prefix_trie(turns, turns.select("conv").distinct()))


def conversations(n, seed):
    draw = random.Random(seed)
    return {k * 3 - 20: [(draw.choice("ua"), draw.choice(["", "hi", "yes é", "no\n"])) for _ in range(draw.randrange(1, 6))] for k in range(n)}


def as_rows(given):
    return [(conv, place, role, text) for conv, turns in given.items() for place, (role, text) in enumerate(turns)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_every_subtree(spark, seed):
    given = conversations(150, seed)
    assert trie(spark, as_rows(given)) == expected(given)


def test_small_blocks_and_chunks(spark, monkeypatch):
    """Sums that go on over blocks of turns, and lists that go on over chunks, change nothing."""
    monkeypatch.setattr(tries, "BLOCK", 2)
    monkeypatch.setattr(tries, "IDS", 3)
    given = conversations(120, 5)
    given[1000] = [("u", str(k % 7)) for k in range(300)]
    given[1001] = given[1000][:299] + [("u", "other")]
    assert trie(spark, as_rows(given)) == expected(given)


def test_nulls_ties_repeats_and_empty_tables(spark):
    rows = [(1, None, "u", "b"), (1, None, "u", "a"), (1, 0, None, None), (1, 0, None, None), (None, 0, "u", "x"), (2, 5, "u", "a"), (2, 6, "u", "b"), (2, 6, "", "")]
    assert trie(spark, rows) == expected({1: [("u", "a"), ("u", "b"), ("", ""), ("", "")], 2: [("u", "a"), ("", ""), ("u", "b")]})
    assert trie(spark, []) == []
    odd = frame(spark, [(1, 0, "u", "long " * 50_000)]).selectExpr("conv_id AS `id.x`", "turn", "role", "text", "1 AS pos", "2 AS conv", "3 AS a")
    turns = tries.ordered_turns(odd, id_col="id.x")
    assert [tuple(r) for r in turns.select("conv", "pos", "size").collect()] == [(1, 1, 250_000)]


def test_members_without_turns(spark):
    turns = tries.ordered_turns(frame(spark, [(4, 0, "u", "a")]))
    members = spark.createDataFrame([(4,), (2,), (11,)], "conv long")
    assert nodes(tries.prefix_trie(turns, members)) == expected({4: [("u", "a")], 2: [], 11: []})
    assert nodes(tries.prefix_trie(turns.where("false"), members)) == expected({4: [], 2: [], 11: []})


def test_rebuilt_conversations(spark, sf_dir, tmp_path):
    """The registered query takes heads from the conversation of the same hundred; some lose all turns by it."""
    draw = random.Random(9)
    given = {c: [(draw.choice("ua"), draw.choice(["x", "yy", "z"])) for _ in range(draw.randrange(1, 8))] for c in [*range(100, 160), *range(300, 330), *range(401, 430), -7, 0]}
    frame(spark, as_rows(given)).write.parquet(f"{tmp_path}/conversations.parquet")
    made = {}
    for c, turns in given.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = given.get(int(c - (abs(c) % 100) * (1 if c >= 0 else -1)), [])[:h] + turns[h:]
    assert any(not turns for turns in made.values())
    assert nodes(queries.QUERIES["op13_trie"](spark, str(tmp_path))) == expected(made)


def test_registered_query(spark, sf_dir):
    assert differs(spark, sf_dir, "op13_trie") is None
