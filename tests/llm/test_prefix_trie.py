"""The prefix trie against a dictionary of all prefixes, over many shards and one."""

import hashlib
import random
import zlib

import pytest

from entitylake.llm import prefix_trie as L

SCHEMA = "conv_id long, turn long, role string, text string"


def _md5(turn):
    role, text = turn
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows, rebuild):
    """Nodes from plain loops over all prefixes."""
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, _md5((role or "", text or "")), (role or "", text or "")))
    own = {conv: [x[3] for x in sorted(found)] for conv, found in turns.items()}
    whole = {}
    for conv, mine in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        whole[conv] = own.get(conv - conv % 100, [])[:h] + mine[h:] if rebuild else mine
    members, children = {}, {}
    for conv, sequence in whole.items():
        for depth in range(len(sequence) + 1):
            members.setdefault(tuple(sequence[:depth]), []).append(conv)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[c] for c in below) if below else 1
        saved[node] = sum(saved[c] for c in below) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append(
            (min(convs), len(node), parent, len(convs), len(children.get(node, [])), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=str)


def found(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.select(names).collect()), key=str)


def planted(seed):
    draw = random.Random(seed)
    rows = []
    for conv in draw.sample(range(450), 90):
        n = draw.choice([0, 1, 2, 3, 5, 8])
        rows += [(conv, draw.choice([t, t, None]), draw.choice(["user", "assistant", None]), draw.choice(["a", "bb", "", None, "é\U0001f600"])) for t in range(n)]
    # A group of copies that holds a third of all, one of them longer.
    rows += [(conv, t, "user", "same text") for conv in range(1000, 1060) for t in range(4)]
    rows += [(1030, 4, "user", "one more")]
    # Long conversations, alike for more than a strip of the matrix.
    rows += [(conv, t, "user", "x" * (t % 7)) for conv in (2000, 2017, 2034) for t in range(80)] + [(2017, 80, "user", "end"), (2034, 70, "user", "other")]
    rows += [(None, 0, "user", "a"), (None, 1, None, None)] + rows[:6] + [(3000, None, None, None), (-7, 1, "user", "a"), (-7, 2, "user", "")]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("shard_turns", "rebuild"), [(L.SHARD_TURNS, True), (30, True), (30, False), (8, True), (3, False)])
def test_nodes_like_brute_force(spark, shard_turns, rebuild):
    rows = planted(shard_turns)
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    # Spark's remainder keeps the sign, as SQL does.
    wanted = brute([row for row in rows if not rebuild or row[0] is None or row[0] >= 0], rebuild)
    table = table.where("NOT (conv_id < 0)" if rebuild else "true")
    assert found(L.trie(table, rebuild, shard_turns)) == wanted


def test_copies_are_cut_into_several_shards(spark):
    table = spark.createDataFrame([(conv, t, "user", "same") for conv in range(300) for t in range(3)], SCHEMA)
    rows = L.written(L.sequences(table, rebuild=False))
    assert L.shards(rows, 50).groupBy("shard").count().count() > 3
    assert found(L.nodes(rows, 50)) == brute([tuple(r) for r in table.collect()], False)


def test_empty_and_turnless(spark):
    assert L.trie(spark.createDataFrame([], SCHEMA), True).count() == 0
    # Their family has no first conversation, and they lose their only turn: nothing is left.
    one, two = [conv for conv in range(501, 600) if zlib.crc32(str(conv).encode()) % 6][:2]
    rows = [(one, 0, "user", "a"), (two, 0, "user", "a")]
    assert found(L.trie(spark.createDataFrame(rows, SCHEMA), True)) == brute(rows, True)
    assert found(L.trie(spark.createDataFrame(rows, SCHEMA), True))[0][:5] == (one, 0, None, 2, 0)


def test_other_columns_and_names(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (2, 0, "user", "a")]
    table = spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA + ", family string, NODE string")
    assert found(L.trie(table)) == brute(rows, False)


def test_one_very_long_text_and_roles_that_touch(spark):
    rows = [(1, 0, "user", "y" * 3_000_000), (2, 0, "user", "y" * 3_000_000), (3, 0, "use", "r"), (4, 0, "us", "er")]
    assert found(L.trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows, False)
