"""Ranked lexical search as an exact inner-product search on ball trees of sparse term vectors.

The score of a document is the inner product of a query (its terms' counts times their weights) and the document's vector of saturated term
frequencies, all integers.  Documents lie in blocks; each block gets a ball tree in the query's space: balls halve at the median of the direction
between two far members, and every ball keeps its centroid and its radius, with one radius for each of GROUPS groups of terms.  By
Cauchy-Schwarz in each group no member's product passes <query, centroid> + the sum of the groups' |query| * radius.  Bounds are rounded up by more than
double precision can lose, so no document is cut off that an exact search would return.  For each query the subtrees are taken best bound first;
leaves are scored in 64-bit integers; what cannot reach the k-th best score found so far, in this block or one that the task had before, is left out.

Documents never move: their partitions are read twice, for the counts (documents, terms, documents that hold each asked term) and for
the search, and hand on k rows a query.  Queries are stated and few beside the documents; they are sent to all tasks in portions of at most
QUERIES items and TERMS different terms, however many there are; more portions are more passes.

Defined results: null and empty texts have no terms, are in no count and are never found; items without terms, or without a document that holds one of
them, have no rows; an item that is null or repeats (same id and text) is ranked for each of its rows' distinct pairs of id and text; equal scores
go by doc_id (null first), repeated rows of documents each take a place; very long texts are counted whole; empty tables give an empty
result; other columns are not read and may have any name.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import small_batches

K = 10
#: Items and different terms of a portion of the queries; of one item with more terms the portion is that item.
QUERIES, TERMS = 1000, 20_000
#: Entries of a block's dense matrix, its documents at most, documents of a leaf, groups of terms.
ENTRIES, BLOCK, LEAF, GROUPS = 6_000_000, 4096, 64, 16

_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """Letters and digits of ASCII and all that is beyond ASCII, in runs; only A-Z are lower-cased."""
    return (text or b"").translate(_KEEP).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def saturated(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A document's entries; tf of its n terms."""
    m = 25 + (75 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class BallTree:
    """Balls over the columns of a dense matrix (terms by documents) of non-negative integers; columns are put in the order of the leaves."""

    def __init__(self, matrix: np.ndarray, leaf: int = LEAF, groups: int = GROUPS):
        n_terms, n = matrix.shape
        self.groups = np.arange(n_terms) % groups
        self.n_groups = groups
        order = np.arange(n)
        x = np.ascontiguousarray(matrix.T, dtype=np.float32)  # only places the cuts; bounds are made in double precision
        self.lo, self.hi, self.left = [0], [n], []
        node = 0
        while node < len(self.lo):
            lo, hi = self.lo[node], self.hi[node]
            self.left.append(-1)
            if hi - lo > leaf:
                mine = x[order[lo:hi]]
                far = int(np.argmax(((mine - mine.mean(axis=0)) ** 2).sum(axis=1)))
                direction = mine[far] - mine[int(np.argmax(((mine - mine[far]) ** 2).sum(axis=1)))]
                half = (hi - lo) // 2
                order[lo:hi] = order[lo:hi][np.argpartition(mine @ direction, half)]
                self.left[node] = len(self.lo)
                self.lo += [lo, lo + half]
                self.hi += [lo + half, hi]
            node += 1
        self.order = order
        self.matrix = np.ascontiguousarray(matrix[:, order])
        self.centroid = np.stack([self.matrix[:, lo:hi].mean(axis=1) for lo, hi in zip(self.lo, self.hi, strict=True)])
        by_group = np.argsort(self.groups, kind="stable")
        starts = np.searchsorted(self.groups[by_group], np.arange(min(groups, n_terms)))
        self.radius = np.zeros((len(self.lo), groups))
        for node, (lo, hi) in enumerate(zip(self.lo, self.hi, strict=True)):
            off = (self.matrix[by_group, lo:hi] - self.centroid[node][by_group, None]) ** 2
            if n_terms:
                self.radius[node, : len(starts)] = np.sqrt(np.add.reduceat(off, starts, axis=0).max(axis=1))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each node (row) and query (column): no member's inner product is larger; safe against rounding."""
        size = np.zeros((self.n_groups, queries.shape[1]))
        np.add.at(size, self.groups, queries.astype(np.float64) ** 2)
        # sums of non-negative doubles of some thousand entries lose far less than this share
        return (self.centroid @ queries + self.radius @ np.sqrt(size)) * (1 + 1e-9) + 1


def search(tree: BallTree, ids: np.ndarray, bound: np.ndarray, at: np.ndarray, times: np.ndarray, best: list[tuple[int, int]], k: int = K) -> int:
    """Put the documents of a block into best, a heap of (score, minus doc_id's order), for the query with times at rows at; how many were scored."""
    ways, scored = [(-bound[0], 0)], 0
    while ways:
        reach, node = heapq.heappop(ways)
        if len(best) == k and -reach < best[0][0]:
            break
        left = tree.left[node]
        if left >= 0:
            for child in (left, left + 1):
                if len(best) < k or bound[child] >= best[0][0]:
                    heapq.heappush(ways, (-bound[child], child))
            continue
        lo, hi = tree.lo[node], tree.hi[node]
        scored += hi - lo
        score = times @ tree.matrix[at, lo:hi].astype(np.int64)
        least = best[0][0] if len(best) == k else 1
        for j in np.flatnonzero(score >= max(1, least)).tolist():
            entry = (int(score[j]), -int(ids[lo + j]))
            if len(best) < k:
                heapq.heappush(best, entry)
            elif entry > best[0]:
                heapq.heapreplace(best, entry)
    return scored


#: Stands for a null id, before all others.
_NO_ID = -(1 << 63)


def _counts(asked: set[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each asked term that stands in the task's documents, and one (no term) of their number and their terms."""
        df: Counter[bytes] = Counter()
        n_docs = n_terms = 0
        for b in batches:
            for text in b.column(0).cast(pa.binary()).to_pylist():
                found = terms(text)
                n_docs, n_terms = n_docs + bool(found), n_terms + len(found)
                df.update(asked.intersection(found))
        columns = [pa.array([None, *df], pa.binary()), pa.array([n_docs, *df.values()], pa.int64()), pa.array([n_terms, *[0] * len(df)], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["term", "n", "n_terms"])

    return run


def _search(items: list[Counter], weights: dict[bytes, int], n_docs: int, n_terms: int, k: int):
    place = {t: i for i, t in enumerate(weights)}
    rows = [(np.array([place[t] for t in q if t in place], np.int64), np.array([c * weights[t] for t, c in q.items() if t in place], np.int64)) for q in items]
    size = max(LEAF, min(BLOCK, ENTRIES // max(1, len(place))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in rows]
        held: list[tuple[int, int, list[int], list[int]]] = []  # id, number of terms, places of asked terms, their counts

        def flush() -> None:
            n = np.array([h[1] for h in held], np.int64)
            lengths = [len(h[2]) for h in held]
            columns = np.repeat(np.arange(len(held)), lengths)
            at = np.fromiter((p for h in held for p in h[2]), np.int64, len(columns))
            tf = np.fromiter((c for h in held for c in h[3]), np.int64, len(columns))
            here, row = np.unique(at, return_inverse=True)
            matrix = np.zeros((len(here), len(held)), np.int32)
            matrix[row, columns] = saturated(tf, n[columns], n_docs, n_terms)
            tree = BallTree(matrix)
            ids = np.array([h[0] for h in held], np.int64)[tree.order]
            met = [np.isin(p, here) for p, _ in rows]
            for lo in range(0, len(rows), 256):
                queries = np.zeros((len(here), min(256, len(rows) - lo)))
                for j, (p, times) in enumerate(rows[lo : lo + 256]):
                    queries[np.searchsorted(here, p[met[lo + j]]), j] = times[met[lo + j]]
                bound = tree.bounds(queries)
                for j, (p, times) in enumerate(rows[lo : lo + 256]):
                    m = met[lo + j]
                    if m.any():
                        search(tree, ids, bound[:, j], np.searchsorted(here, p[m]), times[m], best[lo + j], k)
            held.clear()

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                found = terms(text)
                asked = Counter(p for t in found if (p := place.get(t)) is not None)
                if asked:
                    held.append((_NO_ID + 1 if doc_id is None else doc_id, len(found), list(asked), list(asked.values())))
                    if len(held) == size:
                        flush()
        if held:
            flush()
        out = [(i, None if -doc == _NO_ID + 1 else -doc, score) for i, found in enumerate(best) for score, doc in found]
        columns = [pa.array([r[c] for r in out], pa.int64()) for c in range(3)]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return run


def _portions(items: DataFrame) -> Iterator[list[tuple]]:
    """Items (id, text) in portions of bounded size, as the driver reads them one partition after the other."""
    held: list[tuple] = []
    known: set[bytes] = set()
    for item in items.toLocalIterator():
        query = Counter(terms(None if item["t"] is None else item["t"].encode()))
        if held and (len(held) == QUERIES or len(known | query.keys()) > TERMS):
            yield held
            held, known = [], set()
        if query:
            held.append((item["item_id"], query))
            known |= query.keys()
    if held:
        yield held


def ranked(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The k best documents of each item, with a score above 0: item_id, rank (from 1), doc_id, score."""
    spark: SparkSession = docs.sparkSession
    kind = dict(items.dtypes)[item_col]
    rows = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    out = None
    for portion in _portions(items.select(F.col(item_col).alias("item_id"), F.col(item_text).cast("string").alias("t")).distinct()):
        asked = set().union(*(q.keys() for _, q in portion))
        counted = rows.select("t").mapInArrow(_counts(asked), "term binary, n long, n_terms long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("n_terms").alias("n_terms"))
        counts = {r["term"] if r["term"] is None else bytes(r["term"]): r for r in counted.collect()}  # a row for each asked term
        total = counts.pop(None, None)
        if total is None or not total["n"]:
            continue
        weights = {t: weight(total["n"], r["n"]) for t, r in sorted(counts.items())}
        found = rows.mapInArrow(_search([q for _, q in portion], weights, total["n"], total["n_terms"], k), "item long, doc_id long, score long")
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(portion)], f"item long, item_id {kind}")
        place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc_id"))
        top = found.withColumn("rank", place).filter(F.col("rank") <= k).join(F.broadcast(names), "item")  # QUERIES rows
        out = top if out is None else out.unionByName(top)
    if out is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return out.select("item_id", "rank", "doc_id", "score")
