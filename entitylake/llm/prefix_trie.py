"""The trie of conversation prefixes, from padded matrices of turn ids.

Turns become narrow rows: the md5 of role and text (a turn's id, 16 bytes) and its code points;
texts go no further. A conversation is one row: its turn ids as bytes, which Spark orders as the
sequences they are. Conversations are range-partitioned by that order (ties by number, so a third
of all conversations being alike makes no large shard), and each shard writes its conversations
with its number. The last and first conversation on both sides of every border tell how deep the
nodes are that the border cuts.

Inside a shard the ids form a matrix, padded with zeros, in strips of some columns, so that one
long conversation widens no other. A strip is sorted by numpy's lexsort; changes between
neighbouring rows, OR-accumulated along the columns, mark where nodes start; reduceat sums each
depth; sums of subtrees go up from the deepest depth. What a shard knows about a node that a
border cuts is one summand: children and single costs are counted where a node starts, leaves
where it ends. So the cut nodes, one path per border, only have to be added up.

Defined results: a null role or text is empty; turns of one conversation are ordered by turn
(null first) and, where that is equal, by the md5 of role and text; repeated rows are turns of
their own; turns without a conversation number belong to no conversation and are left out; an
empty table gives no node, not even a root; other columns are not looked at.

Turn ids and lengths of one conversation (20 bytes a turn) have to fit a task; nothing else is
collected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from entitylake.llm.shared import written

#: The rebuilt conversations: how many form a family, and the most turns taken from its first one.
FAMILY = 100
HEAD = 6

#: Turns of a shard on average, and columns of one strip of its matrix.
SHARD_TURNS = 1_000_000
STRIP = 32

ID_BYTES = 16
EMPTY = hashlib.sha256(b"").hexdigest()

NODE = (
    "node binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, ends binary, first_end long"
)
NAMES = [field.split()[0] for field in NODE.split(", ")]
KINDS = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
SCHEMA = pa.schema([(name, KINDS[field.split()[1]]) for name, field in zip(NAMES, NODE.split(", "), strict=True)])


# --- Conversations as sequences -------------------------------------------


def turn_rows(conversations: DataFrame) -> DataFrame:
    """Per turn: conversation, family, turn number, id as hexadecimal text, code points of its text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        (F.col("conv_id") - F.col("conv_id") % FAMILY).cast("long").alias("family"),
        F.col("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("id"),
        F.length(text).alias("chars"),
    )


def sequences(conversations: DataFrame, rebuild: bool = True) -> DataFrame:
    """Per conversation its turn ids (bytes) and lengths; with ``rebuild`` as the families mix them.

    Turns move once, to the partition of their family; the join on the family then finds both
    sides in place. A family's first conversation meets at most ``FAMILY`` others.
    """
    moved = turn_rows(conversations).repartition("family")
    turn = F.struct("turn", "id", "chars")
    whole = moved.groupBy("family", "conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    if rebuild:
        heads = whole.where(F.col("conv_id") == F.col("family")).select(
            "family", F.slice("turns", 1, HEAD - 1).alias("head")
        )
        taken = (F.crc32(F.col("conv_id").cast("string")) % HEAD).cast("int")
        none = F.slice("turns", 1, 0)
        whole = whole.join(heads, "family", "left").select(
            "conv_id",
            F.concat(
                F.slice(F.coalesce("head", none), F.lit(1), taken),
                F.slice("turns", taken + 1, F.greatest(F.size("turns") - taken, F.lit(0))),
            ).alias("turns"),
        )
    return whole.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), "")).alias("ids"),
        F.transform("turns", lambda t: t["chars"]).alias("chars"),
    )


def shards(rows: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The conversations (a written table) with the number of their range of sequences; written."""
    turns = rows.agg(F.sum(F.size("chars"))).first()[0] or 0
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = max(1, min(max(least, -(-turns // shard_turns)), -(-turns // max(1, min(shard_turns, 1000)))))
    dealt = rows.repartitionByRange(number, "ids", "conv_id")
    return written(dealt.withColumn("shard", F.spark_partition_id()))


def borders(dealt: DataFrame) -> DataFrame:
    """Per shard the depth down to which its first and last path go on in the neighbours; -1 for none.

    One row per shard; the window runs over these few rows.
    """
    ends = dealt.groupBy("shard").agg(F.min("ids").alias("first"), F.max("ids").alias("last"))
    order = Window.orderBy("shard")

    def shared(one: str, other: str):
        """Equal turns at the start of both: hexadecimal texts cut into ids."""
        cut = lambda name: F.regexp_extract_all(F.hex(name), F.lit(".{%d}" % (2 * ID_BYTES)), F.lit(0))
        differ = F.zip_with(cut(one), cut(other), lambda a, b: F.coalesce(a != b, F.lit(True)))
        place = F.array_position(differ, F.lit(True))
        return F.when(F.col(one).isNull() | F.col(other).isNull(), -1).otherwise(
            F.when(place == 0, F.size(differ)).otherwise(place - 1)
        )

    sides = ends.select("*", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after"))
    return written(
        sides.select(
            "shard", shared("first", "before").cast("int").alias("shared_before"), shared("last", "after").cast("int").alias("shared_after")
        )
    )


# --- One shard ------------------------------------------------------------


class Level:
    """Nodes of one depth in the order of the matrix."""

    def __init__(self, depth, parent, rows, count, conv, chars):
        self.depth, self.parent, self.rows = depth, parent, rows
        self.count, self.conv, self.chars = count, conv, chars


def _levels(ids: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, chars: np.ndarray, starts: np.ndarray, convs: np.ndarray):
    """Yields the depths of a shard: nodes by lexsort, change masks and reduceat.

    ``ids`` are the pairs of 64-bit halves of all turns, ``offsets`` where a conversation's begin.
    The rows of a level are conversations in order; a strip keeps only those that reach it.
    """
    rows = np.arange(len(convs))
    group = np.zeros(len(convs), np.int64)
    largest = np.iinfo(np.int64).max
    yield Level(0, np.zeros(1, np.int64), (rows, group), np.array([len(rows)]), np.array([convs.min()]), np.zeros(1, np.int64))
    base = 0
    while True:
        here = lengths[rows] > base
        rows, group = rows[here], group[here]
        if not len(rows):
            return
        width = int(min(STRIP, lengths[rows].max() - base))
        deep = np.minimum(lengths[rows] - base, width)
        matrix = np.zeros((len(rows), 2 * width), np.uint64)
        filled = np.arange(width) < deep[:, None]
        source = (offsets[rows] + base)[:, None] + np.arange(width)
        matrix.reshape(len(rows), width, 2)[filled] = ids[source[filled]]
        order = np.lexsort((convs[rows], deep, *matrix.T[::-1], group))
        rows, group, matrix, deep = rows[order], group[order], matrix[order], deep[order]
        change = np.ones((len(rows), width + 1), bool)
        change[1:, 0] = group[1:] != group[:-1]
        pairs = (matrix[1:] != matrix[:-1]).reshape(-1, width, 2)
        change[1:, 1:] = pairs[:, :, 0] | pairs[:, :, 1]
        change = np.logical_or.accumulate(change, axis=1)
        parent_of = group
        for step in range(1, width + 1):
            inside = deep >= step
            first = np.flatnonzero(change[:, step] & inside)
            node = np.cumsum(change[:, step] & inside) - 1
            count = np.add.reduceat(inside.astype(np.int64), first)
            conv = np.minimum.reduceat(np.where(inside, convs[rows], largest), first)
            last = chars[starts[rows[first]] + base + step - 1]
            yield Level(base + step, parent_of[first], (rows[inside], node[inside]), count, conv, last)
            parent_of = node
        reach = deep == width
        rows, group = rows[reach], node[reach]
        base += width


def _path(ids: np.ndarray, depth: int) -> list[bytes]:
    """Names of the nodes on a conversation's path: a running hash of its ids."""
    running, names = hashlib.blake2b(digest_size=ID_BYTES), []
    names.append(running.digest())
    for turn in ids[:depth]:
        running.update(turn.tobytes())
        names.append(running.digest())
    return names


def shard_nodes(convs: np.ndarray, blobs: list[bytes], chars: list, before: int, after: int) -> Iterator[dict]:
    """All nodes of one shard, depth by depth from below, as columns of ``NODE``.

    Nodes cut by a border have a name and the joined numbers of the conversations that end there;
    the children of a cut node have its name as parent.
    """
    lengths = np.array([len(blob) // ID_BYTES for blob in blobs], np.int64)
    offsets = np.cumsum(lengths) - lengths
    ids = np.frombuffer(b"".join(blobs), ">u8").astype(np.uint64).reshape(-1, 2)
    flat = np.concatenate([np.asarray(c, np.int64) for c in chars]) if len(ids) else np.zeros(0, np.int64)
    first, last = min(range(len(blobs)), key=blobs.__getitem__), max(range(len(blobs)), key=blobs.__getitem__)
    before, after = min(before, int(lengths[first])), min(after, int(lengths[last]))
    first_names, last_names = (
        _path(ids[offsets[row] : offsets[row] + max(depth, 0)], max(depth, 0)) for row, depth in ((first, before), (last, after))
    )
    levels = list(_levels(ids, offsets, lengths, flat, offsets, convs))

    def cut(level: Level) -> tuple[int, int]:
        """Positions of the nodes that go on before and after the shard; -1 for none."""
        rows, node = level.rows
        where = lambda row, depth: int(node[np.flatnonzero(rows == row)[0]]) if level.depth <= depth else -1
        return where(first, before), where(last, after)

    cuts = [cut(level) if level.depth <= max(before, after) else (-1, -1) for level in levels]
    below: Level | None = None
    sums: tuple[np.ndarray, np.ndarray] | None = None
    for number in range(len(levels) - 1, -1, -1):
        level, (earlier, later) = levels[number], cuts[number]
        size = len(level.count)
        children, leaves, saved = (np.zeros(size, np.int64) for _ in range(3))
        if below is not None:
            opened = np.ones(len(below.count), np.int64)
            if cuts[number + 1][0] >= 0:
                opened[cuts[number + 1][0]] = 0
            np.add.at(children, below.parent, opened)
            np.add.at(leaves, below.parent, sums[0])
            np.add.at(saved, below.parent, sums[1])
        inner = np.zeros(size, bool)
        if below is not None:
            inner[below.parent] = True
        closed, begun = np.ones(size, np.int64), np.ones(size, np.int64)
        if later >= 0:
            closed[later] = 0
        if earlier >= 0:
            begun[earlier] = 0
        leaves += np.where(inner, 0, closed)
        saved += (level.count - begun) * level.chars
        names: list[bytes | None] = [None] * size
        if later >= 0:
            names[later] = last_names[level.depth]
        if earlier >= 0:
            names[earlier] = first_names[level.depth]
        parents: list[bytes | None] = [None] * size
        parent_conv = np.zeros(size, np.int64)
        if number:
            above, (before_above, after_above) = levels[number - 1], cuts[number - 1]
            parent_conv = above.conv[level.parent]
            for place, path in ((before_above, first_names), (after_above, last_names)):
                for position in np.flatnonzero(level.parent == place).tolist():
                    parents[position] = path[level.depth - 1]
        unknown = np.array([parent is not None for parent in parents]) | (number == 0)
        rows, node = level.rows
        ending = lengths[rows] == level.depth
        ends: list[bytes] = [b""] * size
        first_end: list[int | None] = [None] * size
        stop_rows, stop_node = rows[ending], node[ending]
        for part in np.split(np.arange(len(stop_rows)), np.flatnonzero(np.diff(stop_node)) + 1):
            if len(part):
                members = np.sort(convs[stop_rows[part]]).tolist()
                ends[stop_node[part[0]]] = ",".join(map(str, members)).encode()
                first_end[stop_node[part[0]]] = members[0]
        digests = [
            None if name is not None else EMPTY if not end else hashlib.sha256(end).hexdigest()
            for name, end in zip(names, ends, strict=True)
        ]
        yield {
            "node": names,
            "parent": parents,
            "depth": np.full(size, level.depth),
            "conv_id": level.conv,
            "parent_conv_id": pa.array(parent_conv, mask=unknown),
            "n_convs": level.count,
            "n_children": children,
            "n_leaves": leaves,
            "saved_tokens": saved,
            "ends_sha256": digests,
            "ends": [end if name is not None else None for name, end in zip(names, ends, strict=True)],
            "first_end": first_end,
        }
        below, sums = level, (leaves, saved)


def _shard(table: pa.Table) -> pa.Table:
    columns = {name: table.column(name) for name in table.column_names}
    found = shard_nodes(
        columns["conv_id"].to_numpy(),
        columns["ids"].to_pylist(),
        columns["chars"].to_pylist(),
        columns["shared_before"][0].as_py(),
        columns["shared_after"][0].as_py(),
    )
    parts = [pa.table({name: pa.array(values[name], SCHEMA.field(name).type) for name in NAMES}) for values in found]
    return pa.concat_tables(parts)


# --- All shards -----------------------------------------------------------


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the summands of each cut node, which come in the order of their ends."""
    summed = [NAMES.index(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    node, ends, conv = NAMES.index("node"), NAMES.index("ends"), NAMES.index("conv_id")
    digest = NAMES.index("ends_sha256")
    held: list | None = None
    running, some, done = hashlib.sha256(), False, []

    def close() -> None:
        held[digest], held[ends] = running.hexdigest(), None
        done.append(held)

    def full() -> pa.RecordBatch:
        columns = zip(*done, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, SCHEMA, strict=True)], schema=SCHEMA)

    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if held is None or held[node] != row[node]:
                if held is not None:
                    close()
                if len(done) == 1000:
                    yield full()
                    done = []
                held, running, some = list(row), hashlib.sha256(), False
            else:
                for place in summed:
                    held[place] += row[place]
                held[conv] = min(held[conv], row[conv])
            if row[ends]:
                running.update(b"," * some + row[ends])
                some = True
    if held is not None:
        close()
        yield full()


def nodes(rows: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie of the conversations ``conv_id, ids, chars``: one row per node."""
    dealt = shards(written(rows), shard_turns)
    # One row per shard, so this side is small whatever the data.
    joined = dealt.join(F.broadcast(borders(dealt)), "shard")
    found = written(joined.groupBy("shard").applyInArrow(_shard, NODE))
    cut = found.where(F.col("node").isNotNull()).repartition("node").sortWithinPartitions("node", "first_end")
    added = written(cut.select(*NAMES).mapInArrow(_added, NODE))
    all_nodes = found.where(F.col("node").isNull()).select(*NAMES).unionByName(added)
    above = added.select(F.col("node").alias("above"), F.col("conv_id").alias("above_conv"))
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    known = all_nodes.where(F.col("parent").isNull()).select(*columns)
    below = all_nodes.where(F.col("parent").isNotNull()).join(above, F.col("parent") == F.col("above"))
    return known.unionByName(below.withColumn("parent_conv_id", F.col("above_conv")).select(*columns))


def trie(conversations: DataFrame, rebuild: bool = False, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The prefix trie of a table of turns (conv_id, turn, role, text)."""
    return nodes(sequences(conversations.select("conv_id", "turn", "role", "text"), rebuild), shard_turns)


#: The same for DuckDB: every prefix of every conversation, and every node under all its ancestors.
SQL = r"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(x)) - 1 AS pos, x AS turn, chars
  FROM (SELECT conv_id, turn, length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS x,
          length(coalesce(text, '')) AS chars FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS family, count(*) AS n,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT FOR c IN string_split(conv_id::VARCHAR, '')]),
      lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) % 6 AS h
  FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT c.conv_id, t.pos, t.turn, t.chars FROM convs c JOIN turns t ON t.conv_id = c.family AND t.pos < c.h
  UNION ALL
  SELECT c.conv_id, least(c.h, coalesce(f.n, 0)) + t.pos - c.h, t.turn, t.chars
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h LEFT JOIN convs f ON f.conv_id = c.family),
sized AS (SELECT c.conv_id, count(r.pos) AS n FROM convs c LEFT JOIN rebuilt r USING (conv_id) GROUP BY ALL),
prefixes AS (
  SELECT conv_id, pos + 1 AS depth, chars, md5(string_agg(md5(turn), '') OVER (PARTITION BY conv_id ORDER BY pos)) AS key FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
nodes AS (
  SELECT p.depth, key, min(p.conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    sha256(coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (s.n = p.depth), '')) AS ends_sha256
  FROM prefixes p JOIN sized s USING (conv_id) GROUP BY p.depth, key),
linked AS (
  SELECT n.*, up.conv_id AS parent_conv_id, up.key AS parent_key FROM nodes n
  LEFT JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
  LEFT JOIN nodes up ON up.depth = n.depth - 1 AND up.key = p.key),
kids AS (SELECT depth - 1 AS depth, parent_key AS key, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY ALL),
full_nodes AS (SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN kids USING (depth, key)),
under AS (
  SELECT p.depth, p.key, sum(CASE WHEN n.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved_tokens
  FROM full_nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY ALL)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM full_nodes JOIN under USING (depth, key)
"""


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the trie of the rebuilt conversations."""
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"), rebuild=True)
