"""Near-duplicate groups by SimHash: pigeonhole blocks, a join on blocks, Hamming checks.

A 64-bit fingerprint is split into seven blocks (a parameter); two that differ in four bits or fewer agree in three
whole blocks at least, so each of the 35 triples of blocks is a join key.  More blocks give longer keys, for more fingerprints: ten give
210 keys of 38 bits.  Only distinct fingerprints are joined.  Within a key the rows are compared in vectorised tiles and only a spanning forest of the
close pairs is passed on (a link is lost only if it joins what other links join already); a key with many rows is
dealt to several tasks as pairs of salted tiles.  Groups are the connected components of those links.

Defined results: null and empty texts have fingerprint zero and link like others; very long texts are counted in pieces, all of
their shingles; repeated rows share a fingerprint; an empty table gives an empty result; a null doc_id gets a fingerprint and, if it is alone,
a null component; columns beside id and text are not read and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, dropped, looked_up, small_batches, written

#: Blocks of a fingerprint.
BLOCKS = 7
#: Rows of one key that are compared in one task; a longer run is dealt out as pairs of tiles.
TILE = 4096
#: So many links (16 bytes each) are joined in one task; rounds over more of them are shuffled.
FEW = 100_000


def fingerprint(text: str | None, words: int = 4, seed: int = 42) -> int:
    """Bits that are set in over half the shingles' XXH64; words are split at ASCII white space, A-Z lower-cased."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    starts = np.cumsum([0] + [len(w) + 1 for w in found])
    n = max(1, len(found) - words + 1)
    ends = (starts[min(words, len(found)) :] - 1)[:n].tolist()
    h = xxhash.xxh64_intdigest
    values = np.array([h(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), ends, strict=True)], np.uint64)
    counts = np.zeros(64, np.int64)
    for lo in range(0, n, 65_536):
        part = np.ascontiguousarray(values[lo : lo + 65_536]).astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def row_key(doc_id: Column, text: Column) -> Column:
    """Tells rows apart by id and text, null or not."""
    return F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text.cast("string"), F.lit("\x00")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, seed: int = 42) -> DataFrame:
    """Per row: its id as doc_id, row_key and fingerprint fp (the 64 bits as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, words, seed) for t in b.column(2).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp)], names=["doc_id", "row_key", "fp"])

    rows = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), row_key(F.col(id_col), F.col(text_col)).alias("row_key"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(run, "doc_id long, row_key long, fp long")


def block_keys(fp: Column, bits: int = 4, blocks: int = BLOCKS) -> Column:
    """One long per choice of blocks that two fingerprints may agree in: the choice's number and the blocks' bits."""
    bounds = [64 * i // blocks for i in range(blocks + 1)]
    part = [(hi - lo, F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))) for lo, hi in zip(bounds, bounds[1:], strict=False)]
    keys = []
    for k, chosen in enumerate(combinations(part, blocks - bits)):
        key, at = F.lit(k << 48), 0
        for width, value in chosen:
            key, at = key.bitwiseOR(F.shiftleft(value, at)), at + width
        keys.append(key)
    return F.array(*keys)


def forest(values: np.ndarray, bits: int, split: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, as pairs of places, of the values (unsigned, distinct) that differ in so many bits at most.

    With split, only links between the first split values and the others count.
    """
    n = len(values)
    root = np.arange(n)
    a_out: list[int] = []
    b_out: list[int] = []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = int(root[i])
        return i

    for lo in range(0, n, 256):
        hi = min(lo + 256, n)
        first = lo if split is None else max(lo, split)
        if split is not None and lo >= split:
            break
        top = hi if split is None else min(hi, split)
        near = np.bitwise_count(values[lo:top, None] ^ values[None, first:]) <= bits
        if split is None:
            near &= np.arange(first, n)[None, :] > np.arange(lo, top)[:, None]
        for i in range(top - lo):
            js = np.flatnonzero(near[i]) + first
            if not len(js):
                continue
            mine = find(lo + i)
            js = js[root[js] != mine]  # most of a dense group is joined already
            for j in js.tolist():
                other = find(j)
                if other != mine:
                    root[max(mine, other)] = min(mine, other)
                    mine = min(mine, other)
                    a_out.append(lo + i)
                    b_out.append(j)
            root[js] = mine
    return np.array(a_out, np.int64), np.array(b_out, np.int64)


def _links(bits: int):
    def edges(fp: np.ndarray, side: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        if side is not None:
            order = np.argsort(side, kind="stable")
            fp = fp[order]
        a, b = forest(fp.view(np.uint64), bits, None if side is None else int((side == 0).sum()))
        return fp[a], fp[b]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (key, tile, side); tile is null where a key's rows are all in one run."""
        held: list[tuple[np.ndarray, ...]] = []

        def flush(k: np.ndarray, t: np.ndarray, fp: np.ndarray, side: np.ndarray) -> pa.RecordBatch | None:
            bounds = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (t[1:] != t[:-1]), [True]]))
            starts, sizes = bounds[:-1], np.diff(bounds)
            two = starts[(sizes == 2) & (t[starts] < 0)]  # most shared keys have just two rows
            two = two[np.bitwise_count(fp[two].view(np.uint64) ^ fp[two + 1].view(np.uint64)) <= bits]
            out = [(fp[two], fp[two + 1])]
            more = (sizes > 2) | ((sizes == 2) & (t[starts] >= 0))
            for lo, n in zip(starts[more].tolist(), sizes[more].tolist(), strict=True):
                hi = lo + n
                out.append(edges(fp[lo:hi], side[lo:hi] if t[lo] >= 0 and t[lo] % 2 == 1 else None))
            a, b = (np.concatenate(x) for x in zip(*out, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"]) if len(a) else None

        for batch in batches:
            held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)))
            last_k, last_t = held[-1][0][-1:], held[-1][1][-1:]
            if not len(last_k) or (held[0][0][0] == last_k[0] and held[0][1][0] == last_t[0]):
                continue
            k, t, fp, side = (np.concatenate(x) for x in zip(*held, strict=True))
            whole = int(np.flatnonzero((k != last_k[0]) | (t != last_t[0]))[-1]) + 1
            if (made := flush(k[:whole], t[:whole], fp[:whole], side[:whole])) is not None:
                yield made
            held = [(k[whole:], t[whole:], fp[whole:], side[whole:])]
        if held:
            k, t, fp, side = (np.concatenate(x) for x in zip(*held, strict=True))
            if len(k) and (made := flush(k, t, fp, side)) is not None:
                yield made

    return run


def near_links(values: DataFrame, bits: int = 4, tile: int = TILE, blocks: int = BLOCKS) -> DataFrame:
    """Links a, b between distinct values fp that differ in at most so many bits: a forest of each key's, duplicates removed."""
    if not 0 <= bits < blocks or 64 * (blocks - bits) // blocks > 47:
        raise ValueError("blocks must be more than the bits, and keys of 47 bits at most")
    parts = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # not fewer for few bytes: each value becomes many keys
    keyed = values.select("fp").repartition(parts, "fp").select("fp", F.explode(block_keys(F.col("fp"), bits, blocks)).alias("key"))
    sizes = keyed.groupBy("key").count().filter(F.col("count") > 1)
    shared = keyed.join(sizes, "key")
    # a long run is dealt out: its rows fall into n salted tiles, and every pair of tiles is one unit of work
    n = F.ceil(F.col("count") / F.lit(tile)).cast("long")
    mine = F.pmod(F.xxhash64("fp"), n)
    units = F.when(F.col("count") <= tile, F.array(F.struct(F.lit(-1).cast("long").alias("tile"), F.lit(0).alias("side")))).otherwise(
        F.transform(
            F.sequence(F.lit(0).cast("long"), n - 1),
            lambda o: F.struct(
                (F.when(o == mine, 2 * (mine * n + mine)).otherwise(2 * (F.least(o, mine) * n + F.greatest(o, mine)) + 1)).alias("tile"),
                F.when(mine > o, 1).otherwise(0).alias("side"),
            ),
        )
    )
    dealt = shared.select("key", "fp", F.explode(units).alias("u")).select("key", F.col("u.tile").alias("tile"), "fp", F.col("u.side").alias("side"))
    sorted_ = dealt.repartition("key", "tile").sortWithinPartitions("key", "tile", "side")
    return small_batches(sorted_).mapInArrow(_links(bits), "a long, b long").distinct()


def links_by_fingerprint(rows: DataFrame, bits: int = 4, tile: int = TILE, blocks: int = BLOCKS) -> DataFrame:
    """Links a, b that join all nodes of rows (fp, node) whose fingerprints are equal or differ in so many bits at most."""
    pairs = written(rows.select("fp", "node").distinct())
    first = written(pairs.groupBy("fp").agg(F.min("node").alias("first")))  # one node stands for the others of its fingerprint
    equal = looked_up(pairs, first, "fp").select(F.col("first").alias("a"), F.col("node").alias("b"))
    near = written(near_links(first, bits, tile, blocks))
    for side in "ab":
        near = looked_up(near, first.withColumnRenamed("fp", side), side).drop(side).withColumnRenamed("first", f"first_{side}")
    return equal.union(near.select("first_a", "first_b")).filter("a <> b")


def _rooted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few links lo, hi, all in one task: each node that has a smaller one in reach, and the smallest."""
    root: dict[int, int] = {}

    def find(i: int) -> int:
        while (up := root.setdefault(i, i)) != i:
            root[i] = i = root.setdefault(up, up)
        return i

    for batch in batches:
        for lo, hi in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            a, b = find(lo), find(hi)
            root[max(a, b)] = min(a, b)
    nodes = [i for i in root if find(i) != i]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(i) for i in nodes], pa.int64())], names=["node", "root"])


def components(links: DataFrame, rounds: int = 60, few: int = FEW) -> DataFrame:
    """Connected components of links a, b: node, root (the smallest node that is reachable).

    Alternates large-star and small-star steps; each is a grouping with a minimum and a join, and each
    round is cut off in the shared checkpoint folder.  Stops when a round changes nothing.  A few links need no rounds, each of which
    would cost some stages of as many tasks as the session has partitions: one task joins them.
    """
    first = written(links.filter("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct())
    if first.limit(few + 1).count() <= few:
        found = written(first.coalesce(1).mapInArrow(_rooted, "node long, root long"))
        dropped(first)
        return found
    edges = cut(first)
    dropped(first)
    before = None
    for _ in range(rounds):
        # only a node with a smaller neighbour has something to look up; one that many hang on is mostly the smallest of all, and is salted
        low = edges.groupBy("hi").agg(F.min("lo").alias("m")).withColumnRenamed("hi", "lo")
        large = looked_up(edges, low, "lo", "left").select(F.coalesce("m", "lo").alias("lo"), "hi").distinct()
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(down, "hi")
        edges = cut(
            small.select(F.col("m").alias("lo"), "hi")
            .union(small.filter("lo <> m").select(F.col("m").alias("lo"), F.col("lo").alias("hi")))
            .distinct()
        )
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    else:
        raise RuntimeError(f"components are not stable after {rounds} rounds")
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))


def named_groups(rows: DataFrame, classes: DataFrame, roots: DataFrame, key: str) -> DataFrame:
    """rows (doc_id, row_key, key) with root and component_id; classes (key, least: smallest doc_id) in the groups of roots (node, root).

    A class or group may hold any part of the rows.
    """
    placed = classes.join(roots, F.col(key) == F.col("node"), "left").select(key, "least", F.coalesce("root", key).alias("root"))
    placed = written(placed)
    best = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(looked_up(placed, best, "root").select(key, "root", "component_id"))
    return looked_up(rows.select("doc_id", "row_key", key), named, key).select("doc_id", "row_key", key, "root", "component_id")


def near_groups(docs: DataFrame, bits: int = 4, id_col: str = "doc_id", text_col: str = "text", blocks: int = BLOCKS) -> DataFrame:
    """Per row of docs: doc_id, row_key, fp, root (names the component), component_id (the smallest doc_id of the component)."""
    rows = written(fingerprints(docs, id_col, text_col))
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    return named_groups(rows, classes, components(near_links(classes, bits, blocks=blocks)), "fp")
