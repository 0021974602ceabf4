"""Near copies by fingerprints and by the Jaccard similarity of word shingles: SimHash and MinHash bands propose, exact similarity decides.

SimHash (``simhash``: pigeonhole blocks, a join on them, Hamming checks, components) proposes all pairs whose fingerprints differ in four bits
or fewer.  That does not reach similarity 0.8, at which texts differ in seven to ten of 64 bits, and blocks for that radius are too short
to be keys.  For the rest each row gets BANDS keys, each of WIDTH minima over its shingles; a pair at similarity s shares none with
probability (1 - s ** WIDTH) ** BANDS, which is 3e-6 at 0.8.  What either way links forms candidate groups; within these pairs are
compared by their whole shingle sets, except those that a tree of count vectors rules out or other links join already (counttree.links_of).  A large group is
cut into leaves, and only pairs of leaves that may hold such a pair meet.  Groups are the connected components of the verified links.

Defined results: words are split at white space and lower-cased; a text of fewer words than a shingle has one shingle, all of
it; very long texts are compared by all of theirs; null and empty texts are copies of each other; repeated rows are in one group; ties do not
arise; an empty table gives an empty result; a null doc_id that is alone gets a null component; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import counttree
from .anchors import Hashes, mixed
from .common import looked_up, small_batches, written
from .simhash import components, fingerprint, links_by_fingerprint, named_groups, row_key

WORDS, SIMILARITY = 5, 0.8
BANDS, WIDTH = 32, 5
#: Rows of a candidate group that are compared in one task; a larger group is cut into leaves of so many.
TILE = 1024

_random = np.random.default_rng(80_085)
_FLIP = _random.integers(1, 1 << 63, (BANDS * WIDTH, 1), dtype=np.uint64)
_TIMES = _random.integers(1, 1 << 63, (BANDS * WIDTH, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLD = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of so many words."""
    data = np.frombuffer(" ".join((text or "").lower().split()).encode("utf-8", "surrogatepass"), np.uint8)
    gaps = np.flatnonzero(data == 32)
    starts, ends = np.append(0, gaps + 1), np.append(gaps, len(data))
    n = max(1, len(starts) - words + 1)
    return np.unique(Hashes(data).of(starts[:n], ends[min(words, len(ends)) - 1 :][:n]))


def band_keys(found: np.ndarray) -> np.ndarray:
    """One hash per band of the least values of its WIDTH orders of the shingles."""
    least = np.full(BANDS * WIDTH, ~np.uint64(0))
    for lo in range(0, len(found), 2048):
        least = np.minimum(least, ((found[lo : lo + 2048] ^ _FLIP) * _TIMES).min(axis=1))
    key = np.arange(BANDS, dtype=np.uint64)
    for part in least.reshape(BANDS, WIDTH).T:
        key = mixed((key + np.uint64(1)) * _FOLD ^ part)
    return key


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [shingles(t) for t in b.column(2).to_pylist()]
        same = np.array([mixed(s).sum(dtype=np.uint64) + np.uint64(len(s)) for s in found], np.uint64).view(np.int64)
        fp = np.array([fingerprint(t) for t in b.column(2).to_pylist()], np.uint64).view(np.int64)
        keys = pa.array([band_keys(s).view(np.int64) for s in found], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(same), pa.array(fp), keys], names=["doc_id", "row_key", "same", "fp", "keys"])


ROWS = "doc_id long, row_key long, same long, fp long, keys array<long>"


def proposed(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """node and root of all that near fingerprints (of rows: fp, same) or band keys (of classes: same, keys) join."""
    keyed = classes.select("same", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("same").alias("a"), F.max("same").alias("b")).filter("a <> b")
    by_band = keyed.join(shared.select("key", "a"), "key").select("a", F.col("same").alias("b")).filter("a <> b")
    return components(links_by_fingerprint(rows.select("fp", F.col("same").alias("node"))).union(by_band))


def near_groups(docs: DataFrame, similarity: float = SIMILARITY, tile: int = TILE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: doc_id, row_key, same (names the set of shingles), root (names the group), component_id (its smallest doc_id)."""
    texts = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), row_key(F.col(id_col), F.col(text_col)).alias("row_key"), F.col(text_col).cast("string").alias("t"))
    rows = written(texts.mapInArrow(_keys, ROWS))
    # copies have one set of keys, which goes on once
    classes = written(rows.groupBy("same").agg(F.min("doc_id").alias("least"), F.min("row_key").alias("row_key"), F.first("keys").alias("keys")))
    candidates = proposed(rows, classes)
    members = candidates.union(candidates.select("root", "root").distinct()).toDF("same", "root")
    sizes = members.groupBy("root").agg(F.count("*").alias("size"))
    asked = looked_up(classes.drop("keys").join(members, "same"), written(sizes), "root").select("row_key", "root", "size", F.col("same").alias("node"))
    met = texts.join(asked, "row_key").dropDuplicates(["row_key"])
    part = Fraction(similarity).limit_denominator(1000)
    sets = counttree.members_of(met, lambda t: shingles(None if t is None else t.decode()))
    roots = components(counttree.links_of(sets, (part.numerator, part.denominator), tile))
    return named_groups(rows, classes.select("same", "least"), roots, "same")
