"""Exact n-gram Jaccard joins: prefix keys lead documents together, count-vector R-trees bound, sets verify.

A document is the set of its distinct k-word shingles. Its point is the vector of counts of shingles by
hashed group; the overlap of two sets is at most the sum of their points' coordinate minima. Points lie
at resolutions that are powers of two, so a finer one folds onto a coarser one by adding.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, membership_bits, membership_place, written
from .components import connected_components
from .groups import Union, sorted_groups
from .words import mix, shingle_hashes, text_bytes, word_hashes


def shingle_sets(column: pa.Array, k: int):
    """The sorted distinct shingles of each row; empty without words."""
    words, offsets = word_hashes(*text_bytes(column))
    for i in range(len(offsets) - 1):
        yield np.unique(shingle_hashes(words[offsets[i] : offsets[i + 1]], k))


def _marks(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set."""
    return int(np.bitwise_xor.reduce(s, initial=np.uint64(0)).view(np.int64)), int(mix(s).sum(dtype=np.uint64).view(np.int64))


def least_overlap(a, b, percent: int):
    """The smallest overlap at which 100 * overlap >= percent * union for sets of sizes a and b."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    """So many first shingles in a common order hold one that is shared with any similar set."""
    return n - -(-percent * n // 100) + 1


def resolution(n: int) -> int:
    """The number of groups for a set of n shingles: a power of two that gives two to four a group."""
    return 1 << max(3, (max(n, 1) // 4).bit_length())


def point(shingles: np.ndarray) -> np.ndarray:
    groups = resolution(len(shingles))
    return np.bincount((mix(shingles) % np.uint64(groups)).astype(np.int64), minlength=groups).astype(np.uint16)


def point_bytes(p: np.ndarray) -> bytes:
    """A byte for each group behind a leading 1, or two behind a 2 where a count needs them."""
    return b"\1" + p.astype(np.uint8).tobytes() if p.max(initial=0) < 256 else b"\2" + p.tobytes()


def read_point(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8 if data[0] == 1 else np.uint16, offset=1)


def fold(points: list[np.ndarray], groups: int) -> np.ndarray:
    return np.stack([p.reshape(-1, groups).sum(axis=0, dtype=np.uint16) for p in points])


class CountTree:
    """An R-tree over points of sets in order of size: a node has the coordinate maxima of `fanout` nodes of the level below."""

    def __init__(self, sizes: np.ndarray, points: np.ndarray, fanout: int = 8):
        self.sizes, self.fanout, self.levels = sizes, fanout, [points]
        while len(self.levels[-1]) > fanout:
            below = self.levels[-1]
            self.levels.append(np.maximum.reduceat(below, np.arange(0, len(below), fanout), axis=0))

    def bounded(self, query: np.ndarray, size: int, start: int, stop: int, percent: int) -> np.ndarray:
        """Positions in [start, stop) whose overlap bound with the query reaches what similarity needs, level by level."""
        nodes = np.arange(len(self.levels[-1]))
        for level in range(len(self.levels) - 1, -1, -1):
            width = self.fanout**level
            nodes = nodes[(nodes * width < stop) & ((nodes + 1) * width > start)]
            lows = self.sizes[np.maximum(nodes * width, start)]  # sizes ascend: the least that a node has to offer
            nodes = nodes[np.minimum(self.levels[level][nodes], query).sum(axis=1, dtype=np.uint32) >= least_overlap(size, lows, percent)]
            if level:
                nodes = (nodes[:, None] * self.fanout + np.arange(self.fanout)).ravel()
                nodes = nodes[nodes < len(self.levels[level - 1])]
        return nodes


def join_group(sizes: np.ndarray, points: list, known: np.ndarray, percent: int, verify: Callable[[int, int], bool] | None) -> Union:
    """Union-find over the members of one group, which must come sorted by size.

    Members with the same `known` label are one already. A pair is tried only while it is in two sets;
    it joins them if its bound holds, and with verify if that says so too. So pairs inside a group of
    near copies are hardly ever tried, and none is given out.
    """
    n = len(sizes)
    union = Union(n)
    _, label = np.unique(known, return_inverse=True)
    heads = np.full(label.max() + 1, n)
    np.minimum.at(heads, label, np.arange(n))
    for i in range(n):
        union.join(int(heads[label[i]]), i)
    if n == 0 or (union.roots() == union.roots()[0]).all():
        return union
    widths = np.array([len(p) for p in points])
    for groups in np.unique(widths).tolist():
        at = np.flatnonzero(widths >= groups)  # sizes ascend, so these are the last ones
        tree = CountTree(sizes[at], fold([points[i] for i in at], groups))
        for q in np.flatnonzero(widths[at] == groups).tolist():
            i = int(at[q])
            stop = int(np.searchsorted(tree.sizes, sizes[i] * 100 // percent, "right"))
            if q + 1 >= stop:
                continue
            roots = union.roots()
            span = roots[at[q + 1 : stop]]
            if (span == roots[i]).all():
                continue
            near = at[tree.bounded(tree.levels[0][q], int(sizes[i]), q + 1, stop, percent)]
            for j in near[roots[near] != roots[i]].tolist():
                if union.root(i) != union.root(j) and (verify is None or verify(i, j)):
                    union.join(i, j)
    return union


def overlap_at_least(a: np.ndarray, b: np.ndarray, least: int) -> bool:
    """Whether two sorted sets share at least so many elements."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a)) >= least


def _tree_task(batches, percent: int, exact: bool):
    """Groups of (g1, g2, side, label, doc, n, data) -> (doc, root)."""
    for group in sorted_groups(batches, 2):
        if group.num_rows < 2:
            continue
        doc, n, label = (group[c].to_numpy() for c in ("doc", "n", "label"))
        data = group["data"].to_pylist()
        order = np.lexsort((doc, n))
        keep = np.concatenate(([True], doc[order][1:] != doc[order][:-1]))
        order = order[keep]
        doc, n, label, data = doc[order], n[order], label[order], [data[i] for i in order]
        verify = None
        if exact:
            sets = [np.frombuffer(d, np.uint64) for d in data]
            points = [point(s) for s in sets]
            verify = lambda i, j: overlap_at_least(sets[i], sets[j], int(least_overlap(n[i], n[j], percent)))
        else:
            points = [read_point(d) for d in data]
        root = doc[join_group(n, points, label, percent, verify).roots()]
        linked = root != doc
        if linked.any():
            yield pa.record_batch([pa.array(doc[linked]), pa.array(root[linked])], names=["src", "dst"])


def linked_in_groups(members: DataFrame, payload: DataFrame, percent: int, exact: bool, block: int) -> DataFrame:
    """Connected components (node, component) of the links found inside groups.

    members: (group, doc), repeated rows allowed; payload: one row (doc, n, data) per doc, data a point or,
    if exact, a set. Groups of more than `block` members are cut into blocks by the hash of the
    document, each joined by the group's first document, so a group of copies however large falls
    together in tasks of a block's size. Only groups that are then still in several parts meet again,
    by pairs of blocks, where documents of one part are not compared.
    """
    sizes = members.groupBy("group").agg(F.count("*").alias("size"), F.min("doc").alias("pivot")).where("size > 1")
    sizes, sizes_path = written(sizes.withColumn("blocks", F.ceil(F.col("size") / block).cast("int")), "sizes")
    placed = members.join(sizes, "group").select("group", "pivot", "blocks", "doc", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int").alias("part"))
    placed, placed_path = written(placed, "placed")  # a join of two tables alone, so that the planner may split large groups
    pivots = sizes.where("blocks > 1").select("group", F.col("pivot").alias("doc"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"))
    first = placed.select("group", "part", "doc").union(pivots.select("group", "part", "doc"))
    task = partial(_tree_task, percent=percent, exact=exact)

    def run(rows: DataFrame) -> DataFrame:
        full = rows.join(payload, "doc").select("group", "part", "label", "doc", "n", "data")
        return full.repartition("group", "part").sortWithinPartitions("group", "part").mapInArrow(task, "src long, dst long")

    spark = members.sparkSession
    edges, path = written(run(first.withColumn("label", F.col("doc"))), "links")
    parts, parts_path = written(connected_components(edges), "parts")
    many = placed.where("blocks > 1").join(parts.toDF("doc", "component"), "doc", "left").withColumn("label", F.coalesce("component", "doc"))
    split = many.groupBy("group").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("group")
    again = many.join(split, "group")
    again = again.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("other <> part")
    pair = F.least("part", "other") * F.col("blocks") + F.greatest("part", "other")
    again, again_path = written(again.select("group", pair.alias("part"), "doc", "label"), "again")
    drop_written(spark, placed_path, sizes_path)
    if again.isEmpty():
        drop_written(spark, path, again_path)
        return parts
    more, more_path = written(run(again).union(edges), "links")
    drop_written(spark, path, parts_path, again_path)
    found = connected_components(more)
    drop_written(spark, more_path)
    return found


def _lists(rows: list[np.ndarray]) -> pa.Array:
    lengths = np.concatenate(([0], np.cumsum([len(x) for x in rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(lengths, pa.array(np.concatenate(rows)))


def _shared_keys(keyed: DataFrame) -> DataFrame:
    """(group, doc) of the keys (key, doc) that several documents hold; keys of one and the same list of documents are one."""
    mark = F.bit_xor(F.xxhash64("doc")).alias("mark")
    lists = keyed.groupBy("key").agg(F.count("*").alias("size"), F.min("doc").alias("low"), F.max("doc").alias("high"), mark).where("size > 1")
    lists = lists.groupBy("size", "low", "high", "mark").agg(F.min("key").alias("key")).select("key")
    return keyed.join(lists.hint("merge"), "key").select(F.col("key").alias("group"), "doc")


def _representatives(described: DataFrame, ids: DataFrame, classes: DataFrame) -> DataFrame:
    """doc, keys, late_keys of the classes' representatives.

    A bit map of fixed size has the documents that represent none; those without a bit are taken where
    they are read, and only the others meet the classes in a join. With very many copies all bits are
    set and all documents meet them: the rows are the same.
    """
    gone = ids.where("n > 0").join(classes.select(F.col("rep").alias("doc")), "doc", "left_anti")
    bits = described.sparkSession.sparkContext.broadcast(membership_bits(gone, "doc"))

    def split(batches, sure: bool):
        for batch in batches:
            place = batch.column(1).to_numpy()
            hit = (bits.value[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            yield batch.filter(pa.array(hit != sure)).select(["doc", "keys", "late_keys"])

    rows = described.where("n > 0").select("doc", membership_place("doc").alias("place"), "keys", "late_keys")
    schema = "doc long, keys array<long>, late_keys array<long>"
    open_ = rows.mapInArrow(partial(split, sure=False), schema).join(classes.select(F.col("rep").alias("doc")), "doc")
    return rows.mapInArrow(partial(split, sure=True), schema).union(open_)


def near_duplicate_groups(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    k: int = 5,
    percent: int = 75,
    block: int = 1024,
    common_share: float = 0.002,
    common_most: int = 1 << 17,
) -> DataFrame:
    """One row per id: n_shingles, component_id, the smallest id reachable over links of Jaccard >= percent/100.

    The join is exact. Equal sets are one class. In an order common to all sets, each class's first
    prefix_length shingles are its keys, and any two similar classes share one; shingles that many
    documents hold come last in that order, so common passages lead few documents together. They are
    counted by every task over all its documents, and kept where a task finds them in `common_share` of
    them; which ones are found changes the cost, never the result. The documents of a key meet in
    count-vector R-trees, and those that the bounds leave together are verified by their sets.

    Words lose the case of A-Z; fewer than k words are one shingle; null, empty and blank texts have no
    shingle and link with nothing. Rows that repeat an id are one document, that of the smallest set;
    rows without an id are left out; an empty table gives no rows. Sets of all documents never move:
    keys of a quarter of the shingles do, and the sets of those documents that have candidates,
    which a bit map of fixed size singles out where they are read.
    """
    spark = documents.sparkSession
    docs = documents.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("doc"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))

    def common(batches):
        held, docs_held = [], 0

        def flush():
            found, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= max(4, common_share * docs_held)
            return pa.record_batch([pa.array(found[often].view(np.int64)), pa.array(n[often])], names=["shingle", "count"])

        size = 0
        for batch in batches:
            for s in shingle_sets(batch.column(0), k):
                held.append(s)
                size, docs_held = size + len(s), docs_held + 1
                if size >= 1 << 22:
                    yield flush()
                    held, docs_held, size = [], 0, 0
        if held:
            yield flush()

    often = docs.select("text").mapInArrow(common, "shingle long, count long").groupBy("shingle").agg(F.sum("count").alias("count"))
    often = often.orderBy(F.col("count").desc(), "shingle").limit(common_most).select("shingle").toArrow()["shingle"].to_numpy().view(np.uint64)
    shared = spark.sparkContext.broadcast(np.sort(often))

    def describe(batches):
        late = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                n, one, two, points, keys, late_keys = [], [], [], [], [], []
                for s in shingle_sets(batch.column(1), k):
                    n.append(len(s))
                    for into, mark in zip((one, two), _marks(s)):
                        into.append(mark)
                    points.append(point_bytes(point(s)))
                    is_late = np.zeros(len(s), bool)
                    if len(s) and len(late):
                        at = np.searchsorted(late, s)
                        at[at == len(late)] = 0
                        is_late = late[at] == s
                    wanted = prefix_length(len(s), percent) if len(s) else 0
                    keys.append(s[~is_late][:wanted].view(np.int64))
                    late_keys.append(s[is_late][: wanted - len(keys[-1])].view(np.int64))
                yield pa.record_batch(
                    [batch.column(0), *(pa.array(x, pa.int64()) for x in (n, one, two)), pa.array(points, pa.binary()), _lists(keys), _lists(late_keys)],
                    names=["doc", "n", "one", "two", "data", "keys", "late_keys"],
                )

    described, described_path = written(docs.mapInArrow(describe, "doc long, n long, one long, two long, data binary, keys array<long>, late_keys array<long>"), "described")
    ids, _ = written(described.groupBy("doc").agg(F.count("*").alias("rows"), F.min(F.struct("n", "one", "two")).alias("of")).select("doc", "rows", "of.*"), "ids")
    repeated = not ids.where("rows > 1").isEmpty()
    if repeated:
        described = described.join(ids.drop("rows"), ["doc", "n", "one", "two"]).dropDuplicates(["doc"])
    classes, _ = written(ids.where("n > 0").groupBy("n", "one", "two").agg(F.min("doc").alias("rep")), "classes")
    reps = _representatives(described, ids, classes)
    # most keys are one document's: they move once, and the count and the join read that exchange; the few that
    # many documents hold are counted before they move, and their join is left to the planner's skew handling
    keyed = reps.select("doc", F.explode("keys").alias("key")).repartition("key")
    late = reps.select("doc", F.explode("late_keys").alias("key"))
    members, members_path = written(_shared_keys(keyed).union(_shared_keys(late)), "members")
    clusters, clusters_path = written(linked_in_groups(members, described.select("doc", "n", "data"), percent, False, block), "clusters")
    drop_written(spark, described_path, members_path)

    wanted = clusters.toDF("doc", "group")
    chosen = spark.sparkContext.broadcast(membership_bits(wanted, "doc"))

    def sets(batches):
        bits = chosen.value
        for batch in batches:
            place = batch.column(1).to_numpy()
            batch = batch.filter(pa.array((bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1))
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                found = list(shingle_sets(part.column(2), k))
                one, two = zip(*(_marks(s) for s in found))
                yield pa.record_batch(
                    [part.column(0), pa.array([len(s) for s in found], pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())],
                    names=["doc", "n", "one", "two", "data"],
                )

    payload = docs.select("doc", membership_place("doc").alias("place"), "text").mapInArrow(sets, "doc long, n long, one long, two long, data binary")
    if repeated:
        payload = payload.join(ids.drop("rows"), ["doc", "n", "one", "two"]).dropDuplicates(["doc"])
    payload, sets_path = written(payload.select("doc", "n", "data"), "sets")
    found = linked_in_groups(wanted.select("group", "doc"), payload, percent, True, block // 2).toDF("rep", "component")
    drop_written(spark, sets_path, clusters_path)
    chosen.unpersist()
    shared.unpersist()
    labelled = classes.join(found, "rep", "left").select("n", "one", "two", F.coalesce("component", "rep").alias("component"))
    joined = ids.join(labelled, ["n", "one", "two"], "left")
    return joined.select(F.col("doc").alias(id_column), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id"))


ORACLE_SQL = r"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS g FROM t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
h AS (SELECT doc_id, hash(g) AS g FROM s),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM h a JOIN h b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM o JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
b AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
r AS (SELECT x AS doc_id, x AS c FROM b UNION SELECT b.y, r.c FROM r JOIN b ON b.x = r.doc_id WHERE r.c < b.y),
c AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
SELECT t.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(coalesce(c.c, t.doc_id), t.doc_id) AS component_id FROM t LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""
