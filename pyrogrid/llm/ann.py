"""Nearest neighbours by inner product with randomly rotated one-bit codes.

Each vector is turned by a fixed random rotation and kept as the signs of its components, packed
into bits, with correction scalars: its norm, apart from a power of two, and the inner product of its direction with its own
code.  The bits and scalars give an unbiased estimate of the inner product with a query and a bound of
its error.  Of a block the vectors of the best estimates are reranked first, with the original vectors in double precision; of the
others only those whose upper bound reaches what the k-th best of these has.

Vectors lie in blocks of ``block_rows``, codes beside originals, queries in blocks too.  Each block of queries meets each block of vectors where
these lie: the pairs are formed partition by partition and neither side is shuffled for it.  A pair hands on at most k rows a query, and
of those Spark keeps the k best before it brings a query's rows together.  ``epsilon`` sets the bound: a vector is missed if the error passes
it, which for epsilon = 3.5 happens to fewer than one vector in a thousand, and matters only to those at the rim of the k best.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, nor do those of
another length than the most frequent one (very long ones among them), since they have no inner product with the rest; rows without an id take no part;
vectors of any magnitude take part,
and products beyond double precision are what it makes of them (zero, infinite); ties go to the smaller id; repeated vectors all count; fewer than k candidates are all returned; an empty table gives an empty result;
columns beside id and vector are not read and may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, small_batches

#: Of a block so many times k vectors are reranked before any bound is used.
FIRST = 4
#: Tasks for the pairs of blocks, for each shuffle partition of the session.
TASKS = 4

BLOCK = "block long, n int, ids binary, bits binary, scalars binary, vectors binary"


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def scaled(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors times powers of two, so that the largest component of each is between a half and one, and these exponents: norms then neither vanish nor overflow."""
    exponent = np.frexp(np.abs(vectors).max(axis=1))[1]
    return np.ldexp(vectors, -exponent[:, None]), exponent


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits, and per vector its scaled norm, <its direction, its code's direction> and the scale's exponent."""
    vectors, exponent = scaled(vectors)
    norm = np.linalg.norm(vectors, axis=1)
    turned = (vectors / norm[:, None]) @ turn.T
    return np.packbits(turned > 0, axis=1), np.stack([norm, np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1]), exponent], axis=1)


def estimates(bits: np.ndarray, scalars: np.ndarray, query: np.ndarray, turn: np.ndarray, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of queries (rows) with coded vectors (columns), and what they are at most.

    Directions are compared in single precision; lengths, and the powers of two that were kept apart, are put on in double precision.
    """
    dim = query.shape[1]
    signs = np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1
    norm, own, exponent = scalars.T
    query, shift = scaled(query)
    size = np.linalg.norm(query, axis=1)
    raw = ((query / size[:, None]) @ turn.T).astype(np.float32) @ signs.T / np.float32(np.sqrt(dim))
    guess = raw.astype(np.float64) / own
    error = epsilon * np.sqrt(np.maximum(1 - own**2, 0)) / own / np.sqrt(max(dim - 1, 1))
    length, power = size[:, None] * norm[None, :], shift[:, None] + exponent[None, :].astype(np.int64)
    with np.errstate(over="ignore", under="ignore"):  # what passes double precision does so in the exact product too
        return np.ldexp(guess * length, power), np.ldexp((guess + error[None, :]) * length, power)


def exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed from the first component to the last: alike for equal rows, here and in other engines."""
    total = np.zeros(len(vectors))
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        for column, x in zip(vectors.T.astype(np.float64), query, strict=True):
            total += column * x
    return total


def best(ids: np.ndarray, bits: np.ndarray, scalars: np.ndarray, vectors: np.ndarray, q_ids: np.ndarray, queries: np.ndarray, turn: np.ndarray, k: int, epsilon: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The k best of a block for each query: query ids, ids, scores; and how many vectors were reranked."""
    guess, most = estimates(bits, scalars, queries, turn, epsilon)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    reranked = 0
    for i, q in enumerate(q_ids):
        own = ids == q
        guess[i, own] = -np.inf
        need = min(k, len(ids) - int(own.sum()))
        if need <= 0:
            continue
        m = min(FIRST * k, len(ids) - int(own.sum()))
        first = np.argpartition(guess[i], len(ids) - m)[len(ids) - m :]
        least = np.partition(exact(vectors[first], queries[i]), m - need)[m - need]
        wanted = most[i] >= least
        wanted[first] = True
        kept = np.flatnonzero(wanted & ~own)
        reranked += len(kept)
        score = exact(vectors[kept], queries[i])
        order = np.lexsort((ids[kept], -score))[:k]
        out.append((np.full(len(order), q), ids[kept][order], score[order]))
    if not out:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(0), 0
    return *(np.concatenate(x) for x in zip(*out, strict=True)), reranked


def _usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(v, lambda x: x != 0)
    kind = "array<float>" if dict(rows.dtypes)[vec_col] == "array<float>" else "array<double>"
    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(kind).alias("v")).filter(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite & some)


def _blocks(rows: DataFrame, dim: int, parts: int) -> DataFrame:
    """Rows of vectors, dealt by a hash and packed: one row per block. Equal rows of one id share a block, all others spread evenly."""
    turn = rotation(dim)

    def block(ids: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        bits, scalars = encode(vectors.astype(np.float64), turn)
        # a block is named by what it holds, so that a task run again gives the same name
        name = int.from_bytes(hashlib.blake2b(ids.tobytes() + vectors.tobytes(), digest_size=8).digest(), "big", signed=True)
        parts = (pa.array([x.tobytes()], pa.binary()) for x in (ids, bits, scalars, vectors))
        return pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([len(ids)], pa.int32()), *parts], names=["block", "n", "ids", "bits", "scalars", "vectors"])

    def run(rows: pa.Table) -> pa.Table:
        v = rows.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        return pa.Table.from_batches([block(rows.column("id").to_numpy(), v)])

    # the number of blocks follows from the number of rows alone, whatever the number of partitions
    named = rows.withColumn("b", F.pmod(F.xxhash64("id", "v"), F.lit(parts)))
    return named.groupBy("b").applyInArrow(run, BLOCK).repartition(parts)


def nearest(rows: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", block_rows: int = 10_000, query_rows: int = 512, epsilon: float = 3.5) -> DataFrame:
    """The k largest inner products of each query with rows of other ids: query_id, rank, vec_id, score."""
    spark = rows.sparkSession
    usable, asked = _usable(rows, id_col, vec_col), _usable(queries, id_col, vec_col)
    shape = usable.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if shape is None:
        return empty
    dim, turn = shape["dim"], rotation(shape["dim"])
    usable, asked = usable.filter(F.size("v") == dim), asked.filter(F.size("v") == dim)
    data_blocks, ask_blocks = int(shape["count"] // block_rows) + 1, int(asked.count() // query_rows) + 1
    # partitions of the one side times those of the other are the tasks of the pairs: some for each core, not more
    tasks = TASKS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    data_parts = min(data_blocks, tasks)
    data = cut(_blocks(usable, dim, data_blocks)).coalesce(data_parts)
    asks = cut(_blocks(asked, dim, ask_blocks)).coalesce(max(1, min(ask_blocks, tasks // data_parts)))
    # every block of the stated queries meets every block of vectors
    sent = asks.select(F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    pairs = data.select("ids", "bits", "scalars", "vectors").crossJoin(sent)
    kind = np.float32 if dict(usable.dtypes)["v"] == "array<float>" else np.float64
    asked_kind = np.float32 if dict(asked.dtypes)["v"] == "array<float>" else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in (r for b in batches for r in zip(*b.columns, strict=True)):
            ids, bits, scalars, vectors, q_ids, q = (x.as_buffer() for x in r)
            ids, q_ids = np.frombuffer(ids, np.int64), np.frombuffer(q_ids, np.int64)
            vectors, q = np.frombuffer(vectors, kind).reshape(-1, dim), np.frombuffer(q, asked_kind).reshape(-1, dim).astype(np.float64)
            bits, scalars = np.frombuffer(bits, np.uint8).reshape(len(ids), -1), np.frombuffer(scalars, np.float64).reshape(-1, 3)
            for lo in range(0, len(q_ids), 64):
                qi, vi, s, _ = best(ids, bits, scalars, vectors, q_ids[lo : lo + 64], q[lo : lo + 64], turn, k, epsilon)
                yield pa.RecordBatch.from_arrays([pa.array(qi, pa.int64()), pa.array(vi, pa.int64()), pa.array(s, pa.float64())], names=["query_id", "vec_id", "score"])

    found = small_batches(pairs).mapInArrow(run, "query_id long, vec_id long, score double")
    # Spark cuts each task's rows of a query to the k best before the shuffle
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
