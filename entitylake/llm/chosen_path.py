"""Near-duplicate documents by a chosen-path similarity join.

Documents with equal sets of word shingles are one class. Classes get minimum hashes and walk
random trees: a node chooses one or two coordinates by a hash of the path so far, and a class
goes on to the children named by its own values there. At first a node chooses 1 / threshold
coordinates on average, so a pair at the threshold has one common child on average. Nodes of
depth ``LEVELS`` are compared exhaustively as long as they are small: a class has up to ``SMALL``
others of different components in it, on average. Larger ones branch on if these are less alike
than ``DENSE`` on average, ``LEVELS`` at a time, with two coordinates per node: a pair at the threshold then has 1.6 common
children on average and hardly dies out, pairs below a similarity of 0.5 do. So what only shares
a passage falls apart into small nodes. Denser ones would only multiply; they are compared where
they are, in blocks, and so is what is still large at ``MAX_LEVELS``. About ``PROBED`` classes of a
large node tell how alike they are; that decides about the way only, no pair is left out.

Independent trees are repeated until a pair at the threshold meets almost surely: ``TREES`` miss
it with a probability of 6e-6 where its nodes of depth 3 are small, and of 4e-5 where all of them
are large and it is sought at depth 9 (at a similarity of 0.85: 2e-6). These are the extinction
probabilities of the branching process, averaged over the equal ones of the ``COORDINATES``.

Only links that join components matter. So each class of a node of depth ``LEVELS`` is first
compared with the node's first one, and confirmed with the most alike of these: one comparison
per class however large the nodes are. From then on only nodes that hold different components
count, at every depth, and of these only pairs of different components: a group of near copies
that links have joined branches no further, and meets strangers in its nodes in proportion to them.
Nodes are compared inside tasks, large ones in pairs of blocks that are bounded by classes and by
shingles: what could be linked by minimum hashes is kept, and of that the pairs of different
components are confirmed on the full sets. Only links leave a task, as many as join components.
So nothing is capped, no link between components is lost within a node, and a group of thousands
of near copies makes no square of rows.

Bounds of the tests before the full sets lie more than 4.5 standard deviations below the
threshold: 98 of 128 one-bit hashes, 36 of 64 minimum hashes.

Defined results: a text without words has an empty set and is linked with nothing; documents
with equal ids and different texts are rows of their own; a null id never becomes a component's
id unless no other is there; an empty table gives no rows; extra columns aren't touched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylake.llm.components import components, roots_of
from entitylake.llm.shared import WORD, fresh_name, slices, written
from entitylake.llm.shingles import MinHash, linked, mixed, shingle_sets

PERCENT = 80
WORDS = 5
TREES = 16
LEVELS = 3
#: Nodes whose classes have more than ``SMALL`` others of different components branch on, to this depth at most.
MAX_LEVELS = 9
SMALL = 1024

#: Mean similarity from which two children per class and coordinate no longer make a node fall apart.
DENSE = 0.5
PROBED = 64
COORDINATES = 64
SKETCH_BITS = 128

#: Equal bits of two sketches at a similarity of 0.8 are 0.9 * 128 = 115 with a deviation of 3.4.
LEAST_BITS = 98

#: Equal minimum hashes at a similarity of 0.8 are 51 of 64 with a deviation of 3.2.
LEAST_EQUAL = 36

#: Classes, and their shingles, in a block; larger nodes are compared block by block.
BLOCK = 1024
BLOCK_SHINGLES = 1_000_000

#: Sets of fewer shingles have no other set within the threshold.
LEAST_SET = 4


def _signer(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = MinHash(SKETCH_BITS)
        for batch in slices(batches, 1):
            sets = shingle_sets(batch.column(1).to_pylist(), words)
            sizes = [len(x) for x in sets]
            keys = [hashlib.md5(x.tobytes()).digest() if len(x) else None for x in sets]
            wide = [k for k, n in enumerate(sizes) if n >= LEAST_SET]
            minima = hashes.of([sets[k] for k in wide]) if wide else np.empty((0, SKETCH_BITS), np.uint32)
            bits = np.packbits((minima.astype(np.uint64) * np.uint64(0x9E3779B1) >> np.uint64(31) & np.uint64(1)).astype(np.uint8), axis=1)
            halves = bits.reshape(-1).view("<i8").reshape(-1, 2)
            signature: list[bytes | None] = [None] * len(sets)
            sketch: list[tuple[int | None, int | None]] = [(None, None)] * len(sets)
            for row, k in enumerate(wide):
                signature[k] = minima[row, :COORDINATES].astype("<u4").tobytes()
                sketch[k] = (int(halves[row, 0]), int(halves[row, 1]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(keys, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array(signature, pa.binary()),
                    pa.array([x for x, _ in sketch], pa.int64()),
                    pa.array([x for _, x in sketch], pa.int64()),
                ],
                ["doc_id", "text_hash", "set_key", "n_shingles", "signature", "sketch0", "sketch1"],
            )

    return run


def _roots() -> np.ndarray:
    return mixed(np.arange(1, TREES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def children(
    nodes: np.ndarray, rows: np.ndarray, values: np.ndarray, levels: int, always_two: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Walk down from nodes: the children's hashes and the rows that reach them."""
    for _ in range(levels):
        first = (nodes % np.uint64(COORDINATES)).astype(np.int64)
        # Two coordinates, or two for one node in four: 1.25 = 1 / 0.8 on average.
        forked = np.arange(len(nodes)) if always_two else np.flatnonzero((nodes >> np.uint64(40)) & np.uint64(3) == 0)
        second = (first[forked] + 1 + ((nodes[forked] >> np.uint64(20)) % np.uint64(COORDINATES - 1)).astype(np.int64)) % COORDINATES
        from_nodes = np.concatenate([nodes, nodes[forked]])
        where = np.concatenate([first, second])
        rows = np.concatenate([rows, rows[forked]])
        step = values[rows, where].astype(np.uint64) | (where.astype(np.uint64) + np.uint64(1)) << np.uint64(32)
        nodes = mixed(from_nodes ^ mixed(step))
    return nodes, rows


def _walker(levels: int, from_root: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4").reshape(-1, COORDINATES)
            count = len(values)
            if from_root:
                nodes, rows = np.repeat(_roots(), count), np.tile(np.arange(count), TREES)
            else:
                nodes, rows = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64), np.arange(count)
            nodes, rows = children(nodes, rows, values, levels, always_two=not from_root)
            numbers = batch.column(0).to_numpy(zero_copy_only=False)[rows]
            for low in range(0, len(nodes), 100_000):
                part = slice(low, low + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[part].view(np.int64)), pa.array(numbers[part])], ["node", "class"]
                )

    return run


def _confirmer(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(slices(batches, 2), 3):
            ones, twos = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            different = list(dict.fromkeys([*ones, *twos]))
            sets = dict(zip(different, shingle_sets(different, words), strict=True))
            right = [linked(sets[one], sets[two], percent) for one, two in zip(ones, twos, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(pa.array(right))

    return run


def _shared(nodes: DataFrame) -> DataFrame:
    """Rows of nodes that more than one class reaches."""
    counts = nodes.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
    return written(nodes.join(counts, "node").select("node", "class"))


def candidates(classes: DataFrame) -> DataFrame:
    """Rows (node, class) of the nodes of depth ``LEVELS`` that several classes reach."""
    rows = classes.where("signature IS NOT NULL").select("class", "signature")
    return _shared(written(rows.mapInArrow(_walker(LEVELS, True), "node long, class long")))


def uncertain(members: DataFrame, parts: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows (node, class, root, n_shingles) of all nodes to compare: several components, and small, dense or deepest.

    Nodes with more than ``SMALL`` pairs of different components per class branch on until they
    fall apart, unless these pairs are alike; what is large at ``MAX_LEVELS`` is handed out whole.
    """
    signatures = classes.where("signature IS NOT NULL").select("class", "signature")
    roots = parts.select(F.col("vertex").alias("class"), "root")
    found = None
    for level in range(LEVELS, MAX_LEVELS + 1, LEVELS):
        rooted = members.join(roots, "class", "left").select("node", "class", F.coalesce("root", "class").alias("root"))
        ends = rooted.groupBy("node").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a != b")
        here = written(rooted.join(ends.select("node"), "node"))
        if level + LEVELS > MAX_LEVELS:
            found = here if found is None else found.union(here)
            break
        shares = here.groupBy("node", "root").agg(F.count("*").alias("m"))
        totals = shares.groupBy("node").agg(F.sum("m").alias("n"), F.sum(F.col("m") * F.col("m")).alias("own"))
        large = written(totals.where(F.col("n") * F.col("n") - F.col("own") > SMALL * F.col("n")).select("node", "n"))
        if not large.isEmpty():
            probed = here.join(large, "node").where(F.pmod(F.xxhash64("class", "node"), F.col("n")) < PROBED)
            probed = probed.join(signatures, "class").select("node", F.lit(0).alias("one"), F.lit(0).alias("two"), "root", "signature")
            large = written(probed.repartition("node").sortWithinPartitions("node").mapInArrow(_sparse, "node long"))
        ready = here.join(large, "node", "left_anti")
        found = ready if found is None else found.union(ready)
        if large.isEmpty():
            break
        deeper = here.join(large, "node", "left_semi").join(signatures, "class").select("class", "signature", "node")
        members = _shared(written(deeper.mapInArrow(_walker(LEVELS, False), "node long, class long")))
    return found.join(classes.select("class", "n_shingles"), "class")


def stars(members: DataFrame) -> DataFrame:
    """Pairs of each node's first class with its others."""
    first = members.groupBy("node").agg(F.min("class").alias("u"))
    both = members.join(first, "node").where(F.col("u") != F.col("class"))
    return both.select("u", F.col("class").alias("v")).distinct()


def alike(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes allow the threshold and whose sketches are near enough, with the equal bits."""
    facts = classes.select("class", "n_shingles", "sketch0", "sketch1")
    left = facts.toDF("u", "n_u", "u0", "u1")
    right = facts.toDF("v", "n_v", "v0", "v1")
    equal = F.lit(SKETCH_BITS) - F.bit_count(F.col("u0").bitwiseXOR(F.col("v0"))) - F.bit_count(F.col("u1").bitwiseXOR(F.col("v1")))
    return (
        pairs.join(left, "u")
        .join(right, "v")
        .where(100 * F.least("n_u", "n_v") >= percent * F.greatest("n_u", "n_v"))
        .select("u", "v", equal.alias("bits"))
        .where(F.col("bits") >= LEAST_BITS)
    )


def dealt(pool: DataFrame) -> DataFrame:
    """Rows (node, one, two, own, class, root): the groups to compare.

    A node within the bounds of a block is one group. The classes of a larger one are dealt into
    blocks by hash; each block is a group (``one`` = ``two``), and each pair of blocks, of which
    only classes of different blocks are compared.
    """
    sizes = pool.groupBy("node").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("m"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("m") / BLOCK_SHINGLES)).cast("int")
    own = F.pmod(F.xxhash64("class", F.lit(5)), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least(F.col("own"), other).alias("one"), F.greatest(F.col("own"), other).alias("two")),
    )
    rows = pool.join(sizes.select("node", blocks.alias("blocks")), "node").withColumn("own", own)
    return rows.select("node", F.inline(pairs), "own", "class", "root")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows with equal values in the first three columns."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3)])
        edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for low, high in zip(edges, edges[1:], strict=False):
            here = tuple(keys[:, low].tolist())
            if held and here != key:
                yield pa.Table.from_batches(held)
                held = []
            key = here
            held.append(batch.slice(low, high - low))
    if held:
        yield pa.Table.from_batches(held)


class _Group:
    """Minimum hashes and components of a group's rows, the rows of its first block in front."""

    def __init__(self, rows: pa.Table) -> None:
        self.signatures = np.frombuffer(b"".join(rows.column("signature").to_pylist()), "<u4").reshape(-1, COORDINATES)
        self.roots = rows.column("root").to_numpy()
        one, two = rows.column("one")[0].as_py(), rows.column("two")[0].as_py()
        self.apart = one != two
        #: How many rows to compare with later ones; of two blocks, only rows of the other one.
        self.front = int((rows.column("own").to_numpy() == one).sum()) if self.apart else len(self.roots)
        names, numbers, counts = np.unique(self.roots, return_inverse=True, return_counts=True)
        #: Rows outside the most frequent component: all that rows of that one have to be compared with.
        self.frequent = names[counts.argmax()]
        self.others = np.flatnonzero(numbers != counts.argmax())
        self.other_signatures = self.signatures[self.others]

    def near(self, k: int) -> np.ndarray:
        """Later rows of other components whose minimum hashes allow a link with row k."""
        low = self.front if self.apart else k + 1
        if self.roots[k] == self.frequent:
            start = int(np.searchsorted(self.others, low))
            equal = (self.other_signatures[start:] == self.signatures[k]).sum(axis=1)
            return self.others[start:][equal >= LEAST_EQUAL]
        equal = (self.signatures[low:] == self.signatures[k]).sum(axis=1)
        return np.flatnonzero((equal >= LEAST_EQUAL) & (self.roots[low:] != self.roots[k])) + low


def _survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, one, two, own, class, root, signature) that could be linked with another of their group."""
    for rows in _groups(batches):
        group = _Group(rows)
        keep = np.zeros(len(group.roots), bool)
        for k in range(group.front):
            found = group.near(k)
            if len(found):
                keep[k] = True
                keep[found] = True
        if keep.any():
            yield from rows.filter(pa.array(keep)).combine_chunks().to_batches()


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes whose probed rows of different components are less alike than ``DENSE`` on average."""
    for rows in _groups(batches):
        group = _Group(rows)
        equal, pairs = 0, 0
        for k in range(len(group.roots) - 1):
            apart = group.roots[k + 1 :] != group.roots[k]
            equal += int((group.signatures[k + 1 :][apart] == group.signatures[k]).sum())
            pairs += int(apart.sum())
        if equal < DENSE * pairs * COORDINATES:
            yield pa.RecordBatch.from_arrays([rows.column("node")[:1].combine_chunks()], ["node"])


def _joiner(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links (u, v) that join components within a group, confirmed on the full sets."""
        for rows in _groups(batches):
            group = _Group(rows)
            roots = group.roots
            classes = rows.column("class").to_pylist()
            sets = shingle_sets(rows.column("text").to_pylist(), words)
            parent: dict[int, int] = {}

            def find(x: int) -> int:
                while (up := parent.get(x, x)) != x:
                    parent[x] = x = parent.get(up, up)
                return x

            links = []
            for k in range(group.front):
                for j in group.near(k).tolist():
                    one, two = find(int(roots[k])), find(int(roots[j]))
                    if one != two and linked(sets[k], sets[j], percent):
                        parent[max(one, two)] = min(one, two)
                        links.append((classes[k], classes[j]))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links, strict=True)], ["u", "v"])

    return run


def similar(
    docs: DataFrame, ident: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """Per row of the table: doc_id, its set's size, component_id and kept; and the hash of its text and its component.

    The trees and the bounds before the full sets are made for ``PERCENT``; a lower one is refused.
    """
    if not PERCENT <= percent <= 100:
        raise ValueError(f"percent must lie between {PERCENT} and 100")
    body = F.col(f"`{text}`")
    rows = docs.select(F.col(f"`{ident}`").cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("text_hash"))
    schema = "doc_id long, text_hash long, set_key binary, n_shingles long, signature binary, sketch0 long, sketch1 long"
    signed = written(rows.mapInArrow(_signer(words), schema))
    facts = ("n_shingles", "signature", "sketch0", "sketch1")
    classes = written(
        signed.where("set_key IS NOT NULL")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("doc_id"), *[F.first(x).alias(x) for x in facts])
        .withColumn("class", F.monotonically_increasing_id())
    )
    parts = _joined(rows, classes, words, percent)
    rooted = classes.join(parts, F.col("class") == F.col("vertex"), "left").select(
        "set_key", "doc_id", F.coalesce("root", "class").alias("component")
    )
    least = rooted.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = rooted.join(least, "component").select("set_key", "component", "component_id")
    whole = signed.select("doc_id", "text_hash", "set_key", "n_shingles").join(named, "set_key", "left")
    own = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return whole.select(
        "doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"), "text_hash", "component"
    )


def _joined(rows: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """Components of the classes, by links confirmed on the full sets: enough of them to join each component."""
    members = candidates(classes)
    pairs = written(alike(stars(members), classes, percent))
    best = pairs.groupBy("v").agg(F.max(F.struct("bits", "u")).alias("x")).select(F.col("x.u").alias("u"), "v")
    texts = written(_texts(rows, classes, best.select("u").union(best.select("v")), words))
    left, right = texts.toDF("u", "text_u"), texts.toDF("v", "text_v")
    both = best.join(left, "u").join(right, "v").select("u", "v", "text_u", "text_v")
    parts = written(roots_of(both.mapInArrow(_confirmer(words, percent), "u long, v long")))

    key = ["node", "one", "two"]
    group = "node long, one int, two int, own int, class long, root long, signature binary"
    pool = written(uncertain(members, parts, classes))
    signed = dealt(pool).join(classes.select("class", "signature"), "class")
    ordered = signed.select(*key, "own", "class", "root", "signature").repartition(*key).sortWithinPartitions(*key, "own")
    left_over = written(ordered.mapInArrow(_survivors, group))
    if left_over.isEmpty():
        return parts
    bodies = _texts(rows, classes, left_over.select("class"), words)
    full = left_over.join(bodies, "class").select(*key, "own", "class", "root", "signature", "text")
    links = full.repartition(*key).sortWithinPartitions(*key, "own").mapInArrow(_joiner(words, percent), "u long, v long")
    links = written(links)
    if links.isEmpty():
        return parts
    # Links between roots, a much smaller graph; what it joins is carried back to all classes.
    one, two = parts.toDF("u", "root_u"), parts.toDF("v", "root_v")
    lifted = links.join(one, "u", "left").join(two, "v", "left").select(
        F.coalesce("root_u", "u").alias("u"), F.coalesce("root_v", "v").alias("v")
    )
    joined = written(components(lifted)).toDF("root", "top")
    moved = parts.join(joined, "root", "left").select("vertex", F.coalesce("top", "root").alias("root"))
    new = joined.join(parts.select(F.col("vertex").alias("root")), "root", "left_anti").toDF("vertex", "root")
    return written(moved.union(new))


def _texts(rows: DataFrame, classes: DataFrame, needed: DataFrame, words: int) -> DataFrame:
    """One text for each class of a list. Ids may repeat, so each text's own set key decides."""
    wanted = classes.join(needed.toDF("class").distinct(), "class", "left_semi").select("class", "set_key", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            sets = shingle_sets(batch.column(2).to_pylist(), words)
            same = [hashlib.md5(x.tobytes()).digest() == key for x, key in zip(sets, batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2)], ["class", "text"]).filter(pa.array(same))

    held = rows.alias("r").join(wanted.alias("w"), F.col("r.doc_id").eqNullSafe(F.col("w.doc_id")))
    return held.select("w.class", "w.set_key", "r.text").mapInArrow(run, "class long, text string").dropDuplicates(["class"])


def deduplicated(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group of near duplicates, with the columns of the input.

    It is the one with the smallest id that isn't null (and hash of the text, where ids repeat);
    of fully repeated rows one stays. Documents without words are in no group and stay.
    """
    body, number = F.col(f"`{text}`"), F.col(f"`{ident}`").cast("long")
    found = written(similar(docs, ident, text).select("doc_id", "text_hash", "component"))
    grouped = found.where("component IS NOT NULL")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("x")
    one, two = fresh_name(docs, "llm_id"), fresh_name(docs, "llm_hash")
    keep = written(
        grouped.groupBy("component").agg(first).select(F.col("x.doc_id").alias(one), F.col("x.text_hash").alias(two))
    )
    chosen = docs.join(keep, number.eqNullSafe(F.col(one)) & (F.xxhash64(body) == F.col(two)), "left_semi")
    repeated = grouped.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1")
    same = F.col("doc_id").eqNullSafe(F.col(one)) & (F.col("text_hash") == F.col(two))
    if not repeated.join(keep, same, "left_semi").isEmpty():
        chosen = chosen.dropDuplicates([ident, text])
    empty = docs.where(body.isNull() | ~body.rlike(WORD))
    return chosen.unionByName(empty)


def op2_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their components over shingles of four words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return similar(docs, words=4).select("doc_id", "n_shingles", "component_id", "kept")
