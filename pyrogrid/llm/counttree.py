"""Jaccard join of shingle sets by an R-tree of count vectors.

The shingles of a set are hashed into groups, and how many fall into each group is a point.  Two sets share at most the sum over the groups of the
smaller count; for two boxes of points the sum of the smaller upper corners bounds all their pairs.  An R-tree is joined with itself or
another one from the root: pairs of boxes that cannot hold a pair of the wanted similarity are left out, and so are pairs of boxes whose sets
hang together already; pairs of points that pass the bound are verified on the whole sets.

What meets in one tree follows from groups too.  Two sets of similarity num / den and at most n shingles differ in D <= 2n (den - num) / (den + num)
shingles, so of over D / 2 groups one at least differs in one shingle or none.  Each group is dealt to PARTS parts, and what it holds without one of them is a
key, for each part: two such sets share one.  Each set has a number of groups by its size (levels; a set near the end of its level has keys of the next one
too).  Keys without shingles do not count; a set with so many of them that only such ones might agree adds its least shingles as keys (two
sets of that similarity share one of these).  So no link is lost, and texts that share a passage alone hardly ever meet.  What shares a key is a cluster.

A cluster of more than LEAF sets is cut into leaves in the order of their sizes; each leaf is joined with itself and the cluster's first set.  Then leaves are cut
anew in the order of what hangs together, their boxes are joined as rows, and only pairs of leaves that pass the bound and do not hang together yet are
joined.  A copy of another text is not compared at all: equal sets are one point.

Defined results: A-Z are lower-cased, words are split at ASCII white space; a text of fewer words than a shingle has one shingle, all of them; null and empty
texts have empty sets, which link with nothing, not even each other; very long texts are compared by all their shingles; repeated rows and equal
sets are linked; ties do not arise; an empty table gives an empty result; a null doc_id that is alone has a null component; other columns are not read and may
have any name.  Shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import Hashes, mixed
from .common import looked_up, small_batches, written
from .simhash import components, row_key

WORDS = 4
#: The least similarity, as a fraction.
SIMILARITY = (85, 100)
#: Groups of shingles of a point, entries of a node, points of a leaf of the distributed tree.
GROUPS, FANOUT, LEAF = 128, 16, 1024
#: Parts of a group of which one is left out in each key.
PARTS = 3
#: Points are kept in bytes; a full one stands for any count.
FULL, ANY = 255, 1 << 24
_FOLD = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of so many words."""
    data = np.frombuffer(b" ".join((text or b"").lower().split()), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64)
    gaps = np.flatnonzero(data == 32)
    starts, ends = np.append(0, gaps + 1), np.append(gaps, len(data))
    n = max(1, len(starts) - words + 1)
    return np.unique(Hashes(data).of(starts[:n], ends[min(words, len(ends)) - 1 :][:n]))


def most_apart(size: int, similarity: tuple[int, int] = SIMILARITY) -> int:
    """Two different sets of that similarity, the larger one of so many shingles, differ in so many at most."""
    num, den = similarity
    return 2 * size * (den - num) // (den + num)


@cache
def _levels(similarity: tuple[int, int]) -> list[int]:
    """First sizes of the levels; sets of that similarity are in one level or in neighbouring ones."""
    num, den = similarity
    first = [1, 2]
    while first[-1] < 1 << 40:
        hi = first[-1]
        first.append(max(hi + 1, hi * 6 // 5, (hi - 1) * den // num + 1))
    return first


def level_of(size: int, similarity: tuple[int, int] = SIMILARITY) -> list[tuple[int, int]]:
    """The levels, as first sizes of it and of the next one, in which a set of that size can meet another: its own and perhaps the next."""
    num, den = similarity
    first = _levels(similarity)
    k = bisect_right(first, size)
    return [(first[i - 1], first[i]) for i in ((k, k + 1) if size * den >= num * first[k] else (k,))]


def keys_of(found: np.ndarray, similarity: tuple[int, int] = SIMILARITY) -> np.ndarray:
    """Hashes of which two sets of that similarity share one at least, unless they are equal."""
    num, den = similarity
    n, out = len(found), []
    for lo, hi in level_of(n, similarity) if n else []:
        apart = most_apart(hi - 1, similarity)
        if not apart:
            continue
        groups = (apart + 2) // 2 + (apart >= 6) + apart // 32
        part = (found % np.uint64(groups * PARTS)).astype(np.int64)
        sums = np.zeros((groups, PARTS), np.uint64)
        order = np.argsort(part, kind="stable")
        first = np.flatnonzero(np.diff(part[order], prepend=-1))
        sums.ravel()[part[order][first]] = np.add.reduceat(mixed(found[order] ^ _FOLD), first)
        count = np.bincount(part, minlength=groups * PARTS).reshape(groups, PARTS)
        filled = count.sum(axis=1, keepdims=True) > count  # what is left without a part
        named = (np.arange(groups * PARTS) + (lo << 24)).astype(np.uint64).reshape(groups, PARTS)
        content = sums.sum(axis=1, keepdims=True) - sums
        out.append(mixed(content ^ mixed(named * _FOLD))[filled])
        if (~filled.all(axis=1)).sum() >= groups - apart // 2:  # the groups that agree might have keys without shingles only
            out.append(mixed(found[: n - (n * num + den - 1) // den + 1] + np.uint64(lo)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def point(found: np.ndarray) -> np.ndarray:
    """How many shingles fall into each group; groups are told by other bits than those of keys_of."""
    counts = np.bincount((mixed(found + _FOLD) >> np.uint64(32)).astype(np.int64) % GROUPS, minlength=GROUPS)
    return np.minimum(counts, FULL).astype(np.uint8)


def points_of(packed: list[bytes]) -> np.ndarray:
    points = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, GROUPS).astype(np.int32)
    points[points == FULL] = ANY
    return points


class CountTree:
    """An R-tree over points, packed from the bottom; levels[0] are the points, order their places, upper and sizes the boxes' corners."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, label: np.ndarray):
        order = self._packed(points, sizes, label)
        self.order = order
        self.upper, self.least, self.most = [points[order]], [sizes[order]], [sizes[order]]
        while len(self.upper[-1]) > 1:
            at = np.arange(0, len(self.upper[-1]), FANOUT)
            self.upper.append(np.maximum.reduceat(self.upper[-1], at))
            self.least.append(np.minimum.reduceat(self.least[-1], at))
            self.most.append(np.maximum.reduceat(self.most[-1], at))

    @staticmethod
    def _packed(points: np.ndarray, sizes: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Tiles by size, within them by the counts that spread most: sort, tile, recurse."""
        order = np.lexsort((sizes, label))
        wide = np.argsort(-points.var(axis=0))[:2] if len(points) else []
        tile = FANOUT * FANOUT
        for lo in range(0, len(order), tile):
            part = order[lo : lo + tile]
            order[lo : lo + tile] = part[np.lexsort((points[part, wide[1]], points[part, wide[0]], label[part]))]
        return order

    def labels(self, label: np.ndarray) -> list[np.ndarray]:
        """Per box the label of its points, -1 where they differ."""
        out = [label[self.order]]
        while len(out[-1]) > 1:
            at = np.arange(0, len(out[-1]), FANOUT)
            low, high = np.minimum.reduceat(out[-1], at), np.maximum.reduceat(out[-1], at)
            out.append(np.where(low == high, low, -1))
        return out


def may_meet(upper_a: np.ndarray, least_a: np.ndarray, most_a: np.ndarray, upper_b: np.ndarray, least_b: np.ndarray, most_b: np.ndarray, similarity: tuple[int, int]) -> np.ndarray:
    """Whether boxes (rows) can hold a pair: enough in common by the upper corners, and sizes that fit."""
    num, den = similarity
    both = np.minimum(upper_a, upper_b).sum(axis=1)
    return (both * (num + den) >= num * (least_a + least_b)) & (most_a * den >= num * least_b) & (most_b * den >= num * least_a)


def joined(
    sets: list[np.ndarray], points: np.ndarray, sizes: np.ndarray, label: np.ndarray, split: int | None = None, similarity: tuple[int, int] = SIMILARITY
) -> list[tuple[int, int]]:
    """Links that, with the labels, join whatever pairs of the sets with that similarity join; with split, of the first so many with the others."""
    num, den = similarity
    label = np.unique(label, return_inverse=True)[1]
    links: list[tuple[int, int]] = []

    def verified(a: int, b: int) -> bool:
        both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
        return both * (num + den) >= num * (len(sets[a]) + len(sets[b]))

    def check(a: np.ndarray, b: np.ndarray) -> None:
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            if label[i] != label[j] and verified(i, j):
                label[label == label[j]] = label[i]
                links.append((i, j))

    n = len(points)
    sides = [np.arange(n)] if split is None else [np.arange(split), np.arange(split, n)]
    if split is None and n > 2:  # in a group of near copies the first one joins most
        check(np.zeros(n - 1, np.int64), np.arange(1, n))
    trees = [CountTree(points[s], sizes[s], label[s]) for s in sides]
    a, b = trees[0], trees[-1]
    top_a, top_b = len(a.upper) - 1, len(b.upper) - 1
    x, y = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(x):
        la, lb = a.labels(label[sides[0]])[top_a][x], b.labels(label[sides[-1]])[top_b][y]
        open_ = (la != lb) | (la < 0)
        x, y = x[open_], y[open_]
        met = [may_meet(a.upper[top_a][x[i : i + 4096]], a.least[top_a][x[i : i + 4096]], a.most[top_a][x[i : i + 4096]], b.upper[top_b][y[i : i + 4096]], b.least[top_b][y[i : i + 4096]], b.most[top_b][y[i : i + 4096]], similarity) for i in range(0, len(x), 4096)]
        keep = np.concatenate(met) if met else np.zeros(0, bool)
        x, y = x[keep], y[keep]
        if not top_a and not top_b:
            check(sides[0][a.order[x]], sides[-1][b.order[y]])
            break
        down_a, down_b = top_a >= top_b, top_b >= top_a
        for down, tree, side in ((down_a, a, 0), (down_b, b, 1)):
            if down:
                top = (top_a, top_b)[side] - 1
                have = (x, y)[side]
                children = np.minimum(FANOUT, len(tree.upper[top]) - have * FANOUT)
                child = np.repeat(have * FANOUT - np.cumsum(children) + children, children) + np.arange(children.sum())
                x, y = (child, np.repeat(y, children)) if not side else (np.repeat(x, children), child)
        top_a, top_b = top_a - down_a, top_b - down_b
        if split is None:
            x, y = x[x <= y], y[x <= y]
            if not top_a:
                x, y = x[x < y], y[x < y]
    return links


def _rows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingles(t, words) for t in b.column(2).cast(pa.binary()).to_pylist()]
            n = np.array([len(s) for s in found], np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n), pa.array([_name(s) for s in found], pa.int64())], names=["doc_id", "row_key", "n", "same"])

    return run


def _name(found: np.ndarray) -> int:
    """What tells a set from others."""
    return int((mixed(found).sum(dtype=np.uint64) + np.uint64(len(found))).view(np.int64))


#: Sets that a task remembers, so that it gives the keys of copies once.
REMEMBERED = 1 << 20


def _keyed(similarity: tuple[int, int], words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each key of a set, its name beside it; keys are not kept anywhere, but go straight where they meet."""
        seen: set[int] = set()
        for b in batches:
            keys, names = [], []
            for text in b.column(2).cast(pa.binary()).to_pylist():
                found = shingles(text, words)
                if not len(found) or (name := _name(found)) in seen:
                    continue
                seen = seen if len(seen) < REMEMBERED else set()
                seen.add(name)
                keys.append(keys_of(found, similarity))
                names.append(np.full(len(keys[-1]), name, np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(names))], names=["key", "node"])

    return run


def members_of(texts: DataFrame, shingled: Callable[[bytes | None], np.ndarray]) -> DataFrame:
    """Of texts (root, size, node, t): root, size, node, n, point, set and label, which is what hangs together already: nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shingled(t) for t in b.column(3).cast(pa.binary()).to_pylist()]
            packed = (pa.array([x.tobytes() for x in y], pa.binary()) for y in ([point(s) for s in found], found))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(3)), pa.array([len(s) for s in found], pa.int64()), *packed], names=["root", "size", "node", "n", "point", "set"])

    made = texts.select("root", "size", "node", "t").mapInArrow(run, "root long, size long, node long, n long, point binary, set binary")
    return written(made.withColumn("label", F.col("node")))


def _numbered(leaf: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Number the leaves of sorted rows: of one root (column 0) up to so many rows each."""
        task, number, left, before = TaskContext.get().partitionId() << 32, 0, 0, None
        for b in batches:
            names = []
            for root in b.column(0).to_pylist():
                if root != before or not left:
                    number, left, before = number + 1, leaf, root
                left -= 1
                names.append(task + number)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.int64())], names=[*b.schema.names, "leaf"])

    return run


def _links(similarity: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (unit, side, node, label, point, set) come sorted by unit and side; side is 0 throughout where a leaf meets itself."""
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for _, unit in groupby(rows, key=lambda r: r[0]):
            mine = list(unit)
            split = sum(r[1] == 0 for r in mine)
            if len(mine) < 2 or not split:
                continue
            sets = [np.frombuffer(r[5], np.uint64) for r in mine]
            links = joined(sets, points_of([r[4] for r in mine]), np.array([len(x) for x in sets]), np.array([r[3] for r in mine]), None if split == len(mine) else split, similarity)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([mine[x[k]][2] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


_UNIT = "unit long, side int, node long, label long, point binary, set binary"


def _met(units: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Links of units of work (columns of _UNIT)."""
    dealt = units.select("unit", "side", "node", "label", "point", "set").repartition("unit").sortWithinPartitions("unit", "side", "node")
    return dealt.mapInArrow(_links(similarity), "a long, b long").distinct()


def _leaves(members: DataFrame, leaf: int, *order: str) -> DataFrame:
    """members with the number of their leaf; leaves hold up to so many members of one root, in that order."""
    others = [c for c in members.columns if c != "root"]
    # few tasks for few members, whatever the session's number of partitions: a task ends its leaves, and short ones make many pairs
    tasks = 1 + members.count() // (4 * leaf)
    ranged = members.select("root", *others).repartitionByRange("root", *order, "node").sortWithinPartitions("root", *order, "node").coalesce(tasks)
    schema = ", ".join(f"{c} {t}" for c, t in ranged.dtypes)
    return written(ranged.mapInArrow(_numbered(leaf), f"{schema}, leaf long"))


def _pairs_of_leaves(leaves: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Pairs of boxes (leaf_a, leaf_b) of one root that can hold a pair of sets not linked yet."""
    num, den = similarity
    box = leaves.groupBy("root", "leaf").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("n").alias("least"), F.max("n").alias("most"))
    corner = leaves.select("leaf", "point").mapInArrow(_exploded, "leaf long, corner array<int>").groupBy("leaf").agg(*[F.max(F.col("corner")[g]).alias(f"c{g}") for g in range(GROUPS)])
    box = written(box.join(corner.select("leaf", F.array(*[f"c{g}" for g in range(GROUPS)]).alias("corner")), "leaf"))
    a, b = (box.select("root", *[F.col(c).alias(f"{c}_{x}") for c in box.columns if c != "root"]) for x in "ab")
    both = F.aggregate(F.zip_with("corner_a", "corner_b", lambda x, y: F.least(x, y)), F.lit(0).cast("long"), lambda s, x: s + x)
    fits = (F.col("most_a") * den >= num * F.col("least_b")) & (F.col("most_b") * den >= num * F.col("least_a")) & (both * (num + den) >= num * (F.col("least_a") + F.col("least_b")))
    apart = (F.col("low_a") != F.col("low_b")) | (F.col("low_a") != F.col("high_a")) | (F.col("low_b") != F.col("high_b"))
    return a.join(b, "root").filter((F.col("leaf_a") < F.col("leaf_b")) & apart & fits).select("leaf_a", "leaf_b")


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        points = pa.array(list(points_of(b.column(1).to_pylist())) if b.num_rows else [], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([b.column(0), points], names=["leaf", "corner"])


def _starred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, same) come sorted: a link from each further set of a key to the key's first one."""
    key, root = None, 0
    for b in batches:
        if not b.num_rows:
            continue
        k, s = (b.column(i).to_numpy() for i in (0, 1))
        new = np.append(key is None or k[0] != key, k[1:] != k[:-1])
        at = np.maximum.accumulate(np.where(new, np.arange(len(k)), -1))
        first = np.where(at < 0, root, s[np.maximum(at, 0)])
        key, root = k[-1], first[-1]
        link = first != s
        yield pa.RecordBatch.from_arrays([pa.array(first[link]), pa.array(s[link])], names=["a", "b"])


def _clusters(links: DataFrame) -> DataFrame:
    """node and root of all that links join, roots among them."""
    found = components(links)
    return found.union(found.select("root", "root").distinct()).toDF("node", "root")


def links_of(members: DataFrame, similarity: tuple[int, int] = SIMILARITY, leaf: int = LEAF) -> DataFrame:
    """Links a, b that join whatever pairs within the clusters of members (as of members_of) have that similarity."""
    small, large = members.filter(F.col("size") <= leaf), members.filter(F.col("size") > leaf)
    links = _met(small.select(F.col("root").alias("unit"), F.lit(0).alias("side"), "node", "label", "point", "set"), similarity)
    if large.take(1):
        leaves = _leaves(large, leaf, "n")
        # the first set of the cluster is in each of its leaves
        lead = leaves.filter("node = root").select("root", "node", "label", "point", "set")
        more = leaves.select("root", "leaf").distinct().join(lead, "root")
        own = leaves.filter("node <> root").unionByName(more, allowMissingColumns=True)
        once = written(_met(own.select(F.col("leaf").alias("unit"), F.lit(0).alias("side"), "node", "label", "point", "set"), similarity))
        named = components(once).toDF("node", "joined")
        again = large.join(named, "node", "left").withColumn("label", F.coalesce("joined", "label")).drop("joined")
        # narrow in size first, since sizes rule out most pairs of leaves; within, what hangs together lies together
        leaves = _leaves(again.withColumn("band", F.floor(F.log("n") * 12).cast("long")), leaf, "band", "label", "n")
        units = written(_pairs_of_leaves(leaves, similarity).union(leaves.groupBy("leaf").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("leaf", "leaf")).toDF("leaf_a", "leaf_b"))
        unit = F.xxhash64("leaf_a", "leaf_b").alias("unit")
        sided = units.select(unit, F.col("leaf_a").alias("leaf"), F.lit(0).alias("side")).union(units.filter("leaf_a <> leaf_b").select(unit, F.col("leaf_b").alias("leaf"), F.lit(1).alias("side")))
        links = links.union(once).union(_met(leaves.join(sided, "leaf"), similarity))
    return links


def jaccard_groups(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, words: int = WORDS, leaf: int = LEAF, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: doc_id, n_shingles, same (names the set), root (names the group), component_id (the group's smallest doc_id)."""
    if not 0 < similarity[0] <= similarity[1]:
        raise ValueError("similarity is a fraction above 0, up to 1")
    texts = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), row_key(F.col(id_col), F.col(text_col)).alias("row_key"), F.col(text_col).cast("string").alias("t"))
    rows = written(texts.mapInArrow(_rows(words), "doc_id long, row_key long, n long, same long"))
    # equal sets are one point from here on
    classes = written(rows.filter("n > 0").groupBy("same").agg(F.min("doc_id").alias("least"), F.min("row_key").alias("row_key")))
    keyed = texts.mapInArrow(_keyed(similarity, words), "key long, node long").repartition("key").sortWithinPartitions("key", "node")
    clusters = written(_clusters(keyed.mapInArrow(_starred, "a long, b long").distinct()))
    sizes = clusters.groupBy("root").agg(F.count("*").alias("size"))
    asked = written(looked_up(clusters, sizes, "root").join(classes.withColumnRenamed("same", "node"), "node").select("row_key", "root", "size", "node"))
    met = looked_up(texts, asked, "row_key").dropDuplicates(["row_key"]).select("root", "size", "node", "t")
    links = links_of(members_of(met, lambda t: shingles(t, words)), similarity, leaf)
    placed = written(classes.join(components(links), F.col("same") == F.col("node"), "left").select("same", "least", F.coalesce("root", "same").alias("root")))
    best = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(looked_up(placed, best, "root").select("same", "root", "component_id"))
    found = looked_up(rows.select("doc_id", F.col("n").alias("n_shingles"), "same"), named, "same", "left")
    return found.select("doc_id", "n_shingles", "same", "root", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
