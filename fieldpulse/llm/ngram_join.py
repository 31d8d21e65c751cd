"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

Documents with the same set of word shingles form a class; only one representative of each class is joined.
Every representative gets a signature per tree, a short sequence of minimum hashes. A tree is the trie of all its
signatures; a run of signatures with the same first ``depth`` values is a node. The join takes the deepest nodes and those
of prefixes one value shorter at a time. It stops where even a pair right at the threshold, the hardest to
find, is found with the target recall (or at the shortest prefix, with ``Forest.floor_recall``). The pairs found
have no say in that: a large group of copies would lift any figure over all pairs. So the depths are known before, and one job compares them all.

A large group of near copies would cost a comparison per pair. So the members of nodes of more than ``Forest.hub`` members get a pivot first, the
shingles that most of a small sample of them share, and every member is compared exactly with its pivot. The Jaccard distance is a metric: two documents
within half the threshold's distance of the same set are within the threshold of each other. Such a cluster is linked and its links are
counted without a comparison, so a group of near copies costs rows in proportion to its size, and no link is lost. The pivot decides how many fall into
clusters, never which links there are.

All other pairs of a node are compared. Its members are dealt to blocks and each pair of blocks is a task's work; members of the node's largest
cluster meet the others only. A pair is compared once: at the depth and in the first tree of its longest common prefix.
Links are counted and pooled per block pair, so no row per pair is ever made.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.llm.components import connected_components
from fieldpulse.llm.tables import LONG_ROW, ship, stored, whole_groups
from fieldpulse.llm.words import mix, shingles, slices, words

PAIRS_AT_ONCE = 1 << 15


@dataclass(frozen=True)
class Forest:
    """Shape of the forest and of the join.

    ``screen`` is the share of equal signature values below which a pair is not compared exactly: with 60 values
    a pair at the threshold of 0.8 falls below it about once in a million times. ``rounds`` bounds the search for clusters; what is in none
    after that is compared pair by pair. A pivot comes from about ``pivot_sample`` documents, and ``pivot_rows`` members share a copy of it.
    """
    threshold: float = 0.8
    shingle: int = 5
    trees: int = 12
    depth: int = 5
    least_depth: int = 3
    target_recall: float = 0.999
    screen: float = 0.55
    block: int = 256
    block_shingles: int = 1 << 21
    hub: int = 256
    rounds: int = 4
    pivot_sample: int = 63
    pivot_rows: int = 1024

    def chance(self, similarity: np.ndarray, depth: int) -> np.ndarray:
        """Chance that a pair shares a prefix of ``depth`` values in some tree."""
        return 1 - (1 - similarity ** depth) ** self.trees

    @property
    def depths(self) -> list[int]:
        """Prefix lengths from the longest down to where a pair right at the threshold is found with the target recall."""
        enough = [depth for depth in range(self.least_depth, self.depth + 1) if self.chance(np.float64(self.threshold), depth) >= self.target_recall]
        return list(range(self.depth, max([self.least_depth, *enough]) - 1, -1))

    @property
    def floor_recall(self) -> float:
        return float(self.chance(np.float64(self.threshold), self.least_depth))

    @property
    def close(self) -> float:
        """Similarity to a common set from which on two documents are similar for certain; a hair more for rounding."""
        return (1 + self.threshold) / 2 + 1e-12

    @property
    def values(self) -> int:
        return self.trees * self.depth

    def permutations(self) -> tuple[np.ndarray, np.ndarray]:
        draw = np.random.default_rng(20)
        return (draw.integers(0, 1 << 31, self.values, np.uint32) * np.uint32(2) + np.uint32(1),
                draw.integers(0, 1 << 32, self.values, np.uint32))


FEATURES = "doc_id long, text_key binary, n_shingles int, digest binary, signature binary"


def _shingle_sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingles) of each document with a word."""
    for part in slices(batch.column("text")):
        hashes, begins = shingles(words(part), part.n_docs, size)
        for doc in range(part.n_docs):
            if begins[doc] < begins[doc + 1]:
                yield part.first + doc, np.unique(hashes[begins[doc]:begins[doc + 1]])


def _signature(found: np.ndarray, factor: np.ndarray, shift: np.ndarray) -> bytes:
    values = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factor), 0xFFFFFFFF, np.uint32)
    for begin in range(0, len(values), 2048):
        part = factor[:, None] * values[None, begin:begin + 2048] + shift[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return least.astype(">u4").tobytes()


def signatures(docs: DataFrame, forest: Forest) -> DataFrame:
    """Shingle count, digest of the shingle set and MinHash signature of every row with a word and an id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor, shift = forest.permutations()
        for batch in batches:
            rows, counts, digests, signs = [], [], [], []
            for row, found in _shingle_sets(batch, forest.shingle):
                rows.append(row)
                counts.append(len(found))
                total = np.array([found.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(found))], np.uint64)
                digests.append(total.tobytes())
                signs.append(_signature(found, factor, shift))
            held = pa.array(rows, pa.int32())
            yield pa.record_batch([batch.column("doc_id").take(held), batch.column("text_key").take(held), pa.array(counts, pa.int32()),
                                   pa.array(digests, pa.binary()), pa.array(signs, pa.binary())],
                                  ["doc_id", "text_key", "n_shingles", "digest", "signature"])
    return _with_id(docs).mapInArrow(run, FEATURES)


def shingle_table(texts: DataFrame, size: int) -> DataFrame:
    """(doc, shingles) of ``texts(doc, text)``: the sorted distinct shingle hashes of each as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sets = [], []
            for row, found in _shingle_sets(batch, size):
                rows.append(row)
                sets.append(found.tobytes())
            yield pa.record_batch([batch.column("doc").take(pa.array(rows, pa.int32())), pa.array(sets, pa.binary())],
                                  ["doc", "shingles"])
    return texts.select("doc", "text").mapInArrow(run, "doc long, shingles binary")


def _with_id(docs: DataFrame) -> DataFrame:
    """Rows with an id, and a key that tells texts apart: an id may come with several."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2("text", 256)).alias("text_key"), "text").where("doc_id is not null")


def _prefix(tree: Column, depth: Column, forest: Forest) -> Column:
    """Key of the trie node: tree and the first ``depth`` values of its signature."""
    return F.xxhash64(tree, F.substring("signature", tree * F.lit(4 * forest.depth) + F.lit(1), depth * F.lit(4)))


def _members(reps: DataFrame, depths: int | Sequence[int], forest: Forest, *columns: str) -> DataFrame:
    """(node, tree, depth, doc and ``columns``): every representative in its node of every tree at each of the depths."""
    at = [depths] if isinstance(depths, int) else depths
    rows = (reps.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(forest.trees - 1))))
            .withColumn("depth", F.explode(F.array(*map(F.lit, at)))))
    return rows.select(_prefix(F.col("tree"), F.col("depth"), forest).alias("node"), "tree", "depth", "doc", *columns)


def _nodes(reps: DataFrame, depths: int | Sequence[int], forest: Forest) -> DataFrame:
    """The members of the trie nodes at ``depths`` that have a pair to compare, plus the node's counts: ``inner`` members of the node's largest cluster, if
    that is larger than a block, and ``outer`` others."""
    members = _members(reps, depths, forest, "n_shingles", "leader")
    per_cluster = members.groupBy("node", "leader").agg(F.count(F.lit(1)).alias("n"), F.max("n_shingles").alias("longest"))
    shared = per_cluster.groupBy("node").agg(
        F.sum("n").alias("members"), F.max("longest").alias("longest"), F.max(F.when(F.col("leader") >= 0, F.struct("n", "leader"))).alias("bulk"))
    large = F.coalesce(F.col("bulk.n"), F.lit(0)) > forest.block
    shared = (shared.where((F.col("members") > 1) & (F.coalesce(F.col("bulk.n"), F.lit(0)) < F.col("members")))
              .select("node", "longest", F.when(large, F.col("bulk.leader")).otherwise(F.lit(-2)).alias("bulk"),
                      F.when(large, F.col("bulk.n")).otherwise(F.lit(0)).alias("inner"), "members")
              .withColumn("outer", F.col("members") - F.col("inner")))
    # Written first: a join right on an aggregate would keep a large node in one task.
    return members.join(stored(shared.drop("members"), "nodes"), "node")


def _dealt(nodes: DataFrame, forest: Forest) -> DataFrame:
    """Deals the members of each node to blocks and repeats each member for every pair of blocks it is in; inner blocks are paired with outer ones only."""
    size = F.least(F.lit(forest.block), F.greatest(F.lit(2), F.floor(F.lit(forest.block_shingles) / F.col("longest"))))
    inside, dealt = F.col("leader") == F.col("bulk"), F.xxhash64("doc")
    block = F.when(inside, F.col("outer_blocks") + F.pmod(dealt, F.greatest("inner_blocks", F.lit(1)))).otherwise(F.pmod(dealt, F.col("outer_blocks")))
    partners = F.when(inside, F.col("outer_blocks")).otherwise(F.col("outer_blocks") + F.col("inner_blocks"))
    return (nodes.withColumn("outer_blocks", F.ceil(F.col("outer") / size)).withColumn("inner_blocks", F.ceil(F.col("inner") / size))
            .withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), partners - 1)))
            .select(F.xxhash64("node", F.least("block", "other"), F.greatest("block", "other")).alias("cell"),
                    "tree", "depth", "doc", "leader", F.col("block").cast("int").alias("block"),
                    (F.col("block") != F.col("other")).alias("crossed")))


def _gathered(free: DataFrame, rows: int, forest: Forest) -> DataFrame | None:
    """(doc, leader) for the members of nodes with more than ``hub`` members; None if there is no such node.

    A document's rank is the size of all its large nodes: a central one lies in the largest node of most trees. Everyone follows the
    highest-ranking document it shares a large node with, so a group that is spread over the nodes of several trees comes together.
    """
    members = _members(free, forest.depth, forest)
    large = stored(members.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > forest.hub), "large-nodes", rows)
    held = large.agg(F.sum("n")).first()[0]
    if held is None:
        return None
    placed = stored(members.join(large, "node"), "large-members")
    rank = placed.groupBy("doc").agg(F.sum("n").alias("rank"))
    best = stored(placed.select("node", "doc").join(rank, "doc").groupBy("node").agg(F.max(F.struct("rank", (-F.col("doc")).alias("back"))).alias("best")), "leaders", held)
    return stored(placed.join(best, "node").groupBy("doc").agg((-F.max("best")["back"]).alias("leader")), "led", held)


def _pivots(led: DataFrame, sizes: DataFrame, sets: DataFrame, forest: Forest) -> DataFrame:
    """(leader, pivot): the shingles that more than half of a sample of each leader's followers have."""
    def common(table: pa.Table) -> pa.Table:
        held = [np.frombuffer(one.as_buffer(), np.uint64) for one in table.column("shingles")]
        shingle, count = np.unique(np.concatenate(held), return_counts=True)
        return pa.table({"leader": table.column("leader").slice(0, 1), "pivot": pa.array([shingle[2 * count > len(held)].tobytes()], pa.binary())})
    chance = F.pmod(F.xxhash64("doc", F.lit("pivot")), F.lit(1 << 30)) / float(1 << 30)
    sample = led.join(sizes, "leader").where(chance < forest.pivot_sample / F.col("n")).select("doc", "leader")
    return sample.join(sets, "doc").select("leader", "shingles").groupBy("leader").applyInArrow(common, "leader long, pivot binary")


def _close_to_pivot(led: DataFrame, sets: DataFrame, forest: Forest) -> DataFrame:
    """The rows of ``led`` that are close enough to their pivot. It is repeated per ``pivot_rows`` followers, so no task has
    all those of one leader."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for row, (own, pivot) in enumerate(zip(batch.column("shingles"), batch.column("pivot"))):
                a, b = np.frombuffer(own.as_buffer(), np.uint64), np.frombuffer(pivot.as_buffer(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                if both >= forest.close * (len(a) + len(b) - both):
                    keep.append(row)
            yield batch.select(["doc", "leader"]).take(pa.array(keep, pa.int32()))
    rows = led.count()
    sizes = stored(led.groupBy("leader").agg(F.count(F.lit(1)).alias("n")), "leader-sizes", rows)
    salts = F.ceil(F.col("n") / forest.pivot_rows)
    pivots = stored(_pivots(led, sizes, sets, forest), "pivots", rows).join(sizes, "leader").withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("n")
    dealt = led.join(sizes, "leader").withColumn("salt", F.pmod(F.xxhash64("doc"), salts)).drop("n")
    both = dealt.join(sets, "doc").join(pivots, ["leader", "salt"]).select("doc", "leader", "shingles", "pivot")
    return both.coalesce(max(1, -(-rows // forest.pivot_rows))).mapInArrow(run, "doc long, leader long")


def _clusters(reps: DataFrame, sets: DataFrame, forest: Forest) -> DataFrame:
    """``reps`` with the ``leader`` that names the cluster of each document, -1 for those in none."""
    free, found, rows = reps, None, reps.count() * forest.trees
    for number in range(forest.rounds):
        led = _gathered(free, rows, forest)
        if led is None:
            break
        close = stored(_close_to_pivot(led, sets, forest), "clusters")
        # A leader that is in no cluster itself may lead again, so a cluster is named by leader and round.
        named = close.select("doc", (F.col("leader") * forest.rounds + number).alias("leader"))
        found = named if found is None else found.unionByName(named)
        free = free.join(close, "doc", "left_anti")
    if found is None:
        return reps.withColumn("leader", F.lit(-1).cast("long"))
    return stored(reps.join(found, "doc", "left").withColumn("leader", F.coalesce("leader", F.lit(-1).cast("long"))), "clustered")


def _pairs(cells: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows a < b of the same cell, for rows sorted by cell, some at a time."""
    ends = np.searchsorted(cells, cells, "right")
    ahead = ends - np.arange(len(cells)) - 1
    total = np.cumsum(ahead)
    first = 0
    while first < len(cells):
        done = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, done + PAIRS_AT_ONCE, "right")))
        a = np.repeat(np.arange(first, last), ahead[first:last])
        if len(a):
            yield a, a + 1 + np.arange(len(a)) - np.repeat(total[first:last] - ahead[first:last] - done, ahead[first:last])
        first = last


def candidates(reps: DataFrame, dealt: DataFrame, forest: Forest) -> DataFrame:
    """(cell, doc, partners): which documents of a cell to compare with which later ones, by signature alone.

    A pair belongs to the cell at the depth of its longest common prefix, in the first tree that has it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "cell"):
            cells, docs, tree, depth, leader = (table.column(name).to_numpy() for name in ("cell", "doc", "tree", "depth", "leader"))
            block, crossed = table.column("block").to_numpy(), table.column("crossed").to_numpy()
            sign = np.frombuffer(b"".join(table.column("signature").to_pylist()), ">u4").astype(np.uint32)
            sign = sign.reshape(len(cells), forest.trees, forest.depth)
            left, right = [], []
            for a, b in _pairs(cells):
                # A pair of a cluster is linked already.
                keep = ((block[a] != block[b]) | ~crossed[a]) & ((leader[a] != leader[b]) | (leader[a] < 0))
                a, b = a[keep], b[keep]
                same = sign[a] == sign[b]
                common = np.logical_and.accumulate(same, axis=2).sum(axis=2)
                keep = (common.max(axis=1) == depth[a]) & (common.argmax(axis=1) == tree[a]) & (same.mean(axis=(1, 2)) >= forest.screen)
                left.append(a[keep])
                right.append(b[keep])
            if not left or not sum(map(len, left)):
                continue
            a, b = np.concatenate(left), np.concatenate(right)
            rows = np.unique(np.concatenate([a, b]))
            order = np.argsort(a, kind="stable")
            begins = np.searchsorted(a[order], rows)
            counts = np.searchsorted(a[order], rows, "right") - begins
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.record_batch([pa.array(cells[rows]), pa.array(docs[rows]),
                                   pa.ListArray.from_arrays(pa.array(offsets), pa.array(docs[b[order]]))],
                                  ["cell", "doc", "partners"])
    rows = dealt.join(reps.select("doc", "signature"), "doc").repartition("cell").sortWithinPartitions("cell", "signature")
    return rows.mapInArrow(run, "cell long, doc long, partners array<long>")


def _overlaps(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets a[i] and b[i]; many pairs at once go through 0/1 matrices."""
    if len(a) <= 2 * len(sets):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(a, b)], np.int64)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    column = np.unique(np.concatenate(sets), return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    for begin in range(0, int(column[-1]) + 1, 4096):
        one, two = np.searchsorted(column, (begin, begin + 4096))
        ones = np.zeros((len(sets), 4096), np.float32)
        ones[row[one:two], column[one:two] - begin] = 1
        total += ones @ ones.T
    return total[a, b].astype(np.int64)


def _roots(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index connected to each of ``size`` nodes by the edges a, b."""
    root = np.arange(size)
    while True:
        least = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, a, least)
        np.minimum.at(after, b, least)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def verified(found: DataFrame, sets: DataFrame, copies: DataFrame, forest: Forest) -> DataFrame:
    """Exact comparison: per cell and document its links (partners with their copies), and a document it is
    connected to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "cell"):
            cells = table.column("cell").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(cells)) + 1, [len(cells)]])
            columns = {name: table.column(name).combine_chunks() for name in ("doc", "copies", "shingles", "partners")}
            out: list[list] = [[], [], []]
            for first, last in zip(cuts, cuts[1:]):
                size = int(last - first)
                doc = columns["doc"].slice(first, size).to_numpy()
                order = np.argsort(doc)
                weight = columns["copies"].slice(first, size).to_numpy()
                blobs = columns["shingles"].slice(first, size)
                sets_ = [np.frombuffer(blobs[i].as_buffer(), np.uint64) for i in range(size)]
                partners = columns["partners"].slice(first, size)
                a = np.repeat(np.arange(size), partners.value_lengths().to_numpy(zero_copy_only=False))
                b = order[np.searchsorted(doc[order], partners.flatten().to_numpy())]
                if not len(a):
                    continue
                lengths = np.array([len(s) for s in sets_])
                both = _overlaps(sets_, a, b)
                similarity = both / (lengths[a] + lengths[b] - both)
                keep = similarity >= forest.threshold
                a, b = a[keep], b[keep]
                if not len(a):
                    continue
                links = np.bincount(a, weight[b], size) + np.bincount(b, weight[a], size)
                position = np.empty(size, np.int64)
                position[order] = np.arange(size)
                root = doc[order][_roots(size, position[a], position[b])][position]
                rows = np.unique(np.concatenate([a, b]))
                out[0].append(doc[rows])
                out[1].append(links[rows].astype(np.int64))
                out[2].append(root[rows])
            if out[0]:
                yield pa.record_batch([pa.array(np.concatenate(part)) for part in out], ["doc", "links", "root"])
    rows = found.join(sets, "doc").join(copies.select("doc", "copies"), "doc")
    rows = rows.repartition("cell").sortWithinPartitions("cell")
    return rows.mapInArrow(run, "doc long, links long, root long")


@dataclass(frozen=True)
class Joined:
    """``members(doc_id, text_key, doc)``: rows and their class; ``classes(doc, copies, first)``; ``groups(doc, links, first)`` for the classes with a link,
    ``first`` being the smallest (doc_id, text_key) of the class or of its group."""
    members: DataFrame
    classes: DataFrame
    groups: DataFrame


def join_classes(docs: DataFrame, forest: Forest) -> Joined:
    """Finds classes of equal shingle sets, their links and their connected groups."""
    ship(docs.sparkSession)
    features = stored(signatures(docs, forest), "features")
    rows = features.count()
    classes = features.groupBy("digest", "n_shingles").agg(
        F.min(F.struct("doc_id", "text_key")).alias("first"), F.count(F.lit(1)).alias("copies"), F.first("signature").alias("signature"))
    # A class has a number of its own, as two classes may have the same smallest doc_id.
    classes = stored(classes.withColumn("doc", F.monotonically_increasing_id()), "classes", rows)
    members = stored(features.select("doc_id", "text_key", "digest", "n_shingles").join(
        classes.select("digest", "n_shingles", "doc"), ["digest", "n_shingles"]).select("doc_id", "text_key", "doc"), "members", rows)
    wide = stored(_members(classes, forest.least_depth, forest).groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("node"), "shared-nodes", rows * forest.trees)
    wide = stored(_members(classes, forest.least_depth, forest).join(wide, "node", "left_semi").select("doc").distinct(), "shared", rows)
    reps = stored(classes.join(wide, "doc", "left_semi").select("doc", "copies", "n_shingles", "signature", "first"), "representatives")
    texts = _with_id(docs).join(reps.select("doc", "first.doc_id", "first.text_key"), ["doc_id", "text_key"])
    sets = stored(shingle_table(texts, forest.shingle).dropDuplicates(["doc"]), "shingles", reps.count() * LONG_ROW)
    reps = _clusters(reps.drop("first"), sets, forest)
    in_cluster = reps.where("leader >= 0")
    weights = stored(in_cluster.groupBy("leader").agg(F.sum("copies").alias("weight"), F.min("doc").alias("root")), "cluster-weights", rows)
    links = in_cluster.join(weights, "leader").select("doc", (F.col("weight") - F.col("copies")).alias("links"), "root")
    found = candidates(reps, _dealt(_nodes(reps, forest.depths, forest), forest), forest)
    links = links.unionByName(stored(verified(found, sets, reps, forest), "links"))
    counted = links.groupBy("doc").agg(F.sum("links").alias("links"))
    groups = connected_components(links.select(F.col("doc").alias("u"), F.col("root").alias("v")))
    groups = stored(groups.withColumnRenamed("node", "doc").join(classes.select("doc", F.col("first").alias("own")), "doc"), "components", rows)
    first = stored(groups.groupBy("component").agg(F.min("own").alias("first")), "first-of-each", rows)
    groups = groups.join(first, "component").select("doc", "first").join(counted, "doc", "left")
    return Joined(members, classes.select("doc", "copies", "first"), stored(groups, "groups", rows))


def similar_documents(docs: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """All documents of ``docs(doc_id, text)`` with their near copies.

    Returns doc_id, copy_id (smallest document with the same shingle set), copies (documents in that class), n_links
    (other documents at or above the threshold, copies included) and class_id (smallest document of the connected
    group). Words are lower-cased runs of letters and digits; a text of fewer words than a shingle is one shingle.
    A text without words has no shingles and so no links. Rows without doc_id stay, with null classes and no links;
    rows that repeat a doc_id count as copies of each other if their texts agree, and have each their own links if not. Other columns are not used.
    """
    joined = join_classes(docs, forest)
    classes = stored(joined.classes.withColumnRenamed("first", "own").join(joined.groups, "doc", "left").select(
        "doc", F.col("own.doc_id").alias("copy_id"), "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce(F.col("first.doc_id"), F.col("own.doc_id")).alias("class_id")), "class-links")
    found = joined.members.join(classes, "doc").select("doc_id", "copy_id", "copies", "n_links", "class_id")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.regexp_like(
        F.lower(F.coalesce("text", F.lit(""))), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]")).alias("worded"))
    lone = ids.where("doc_id is null or not worded").select(
        "doc_id", F.col("doc_id").alias("copy_id"), F.lit(1).cast("long").alias("copies"),
        F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("class_id"))
    return found.unionByName(lone)


def one_of_each(docs: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """The rows of ``docs`` without near copies: of each connected group the row with the smallest doc_id stays, and of its texts the one with the smallest
    digest.

    Rows are told apart by doc_id and text: an id that comes with two unrelated texts keeps both. Of rows that agree in both one stays. Documents
    without words or without doc_id stay, as they have no links.
    """
    joined = join_classes(docs, forest)
    classes = stored(joined.classes.withColumnRenamed("first", "own").join(joined.groups.select("doc", "first"), "doc", "left").select(
        "doc", F.coalesce("first", "own").alias("first")), "class-firsts")
    rows = joined.members.join(classes, "doc").select("doc_id", "text_key", ((F.col("first.doc_id") == F.col("doc_id")) & (F.col("first.text_key") == F.col("text_key"))).alias("stays"))
    gone = stored(rows.where("not stays").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct(), "near-copies")
    key = F.struct(F.col("doc_id").cast("long").alias("id"), F.unhex(F.sha2("text", 256)).alias("key"))
    packed = docs.select(F.struct(*docs.columns).alias("_row"), key.alias("_place"))
    kept = packed.join(gone, (F.col("_place.id") == F.col("_id")) & (F.col("_place.key") == F.col("_key")), "left_anti")
    twice = stored(rows.where("stays").groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).count().where("count > 1").drop("count"), "repeated-rows")
    if not twice.isEmpty():
        same = (F.col("_place.id") == F.col("_id")) & (F.col("_place.key") == F.col("_key"))
        kept = kept.join(twice, same, "left_anti").unionByName(kept.join(twice, same, "left_semi").dropDuplicates(["_place"]))
    return kept.select("_row.*")
