"""Packing: optimal length buckets and token-budget batches.

Texts longer than ``max_len`` tokens are cut into pieces, so lengths run from 1 to ``max_len`` and the
global histogram is small whatever the corpus.  Dynamic programming over it picks the bucket boundaries
with the least padding; inside a bucket, batches of budget // boundary sequences are filled in a fixed order.
Places in a bucket are found in two levels (places within hashed parts, and sums of the parts before),
so that one hot bucket is spread over many tasks.

A sequence carries its piece of the text; the pieces of a row, put together, are its text, white space included.  Rows are told apart by id, text and copy: (doc_id, text_key, copy, piece) is unique.

Defined results: null and empty texts have no tokens and are one piece of length 0 in the smallest bucket, with an empty text;
very long texts are cut into as many pieces as they need; repeated rows get a place each and count up in copy; ties are ordered by id, piece
and text; an empty table gives an empty result; columns beside id and text are not read and may have any name.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .mixing import hashed

PARTS = 1024


def word_count(text: Column) -> Column:
    """Tokens of a text: its runs of characters that are not white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0))


def boundaries(counts: np.ndarray, buckets: int) -> list[int]:
    """Upper lengths of at most so many buckets that pad least; counts[n] is the number of sequences of length n.

    best[j][b] = least padded size of lengths up to j in b buckets, over boundaries i < j:
    best[i][b - 1] + j * (sequences with lengths over i up to j).  Only lengths that occur are boundaries.
    """
    lengths = np.flatnonzero(counts)
    if not len(lengths):
        return []
    upto = np.concatenate([[0], np.cumsum(counts[lengths])]).astype(np.float64)
    n, buckets = len(lengths), min(buckets, len(lengths))
    best = np.concatenate([[0.0], np.full(n, np.inf)])
    came = []
    for _ in range(buckets):
        table = best[:-1, None] + lengths[None, :] * (upto[None, 1:] - upto[:-1, None])
        table[np.tril_indices(n, -1)] = np.inf  # row i: lengths[i:j + 1] are in the last bucket
        came.append(table.argmin(axis=0))
        best = np.concatenate([[np.inf], table.min(axis=0)])
    out, j = [], n
    for b in reversed(range(buckets)):
        out.append(int(lengths[j - 1]))
        j = int(came[b][j - 1])
        if not j:
            break
    return out[::-1]


def pieces_of(text: Column, max_len: int) -> Column:
    """A text cut after every max_len tokens; white space stays with the token that follows it, or at the end with the one before."""
    # possessive throughout, so that nothing is tried twice and no depth of recursion depends on the text
    cut = F.regexp_extract_all(text, F.lit(rf"(?:\s*+\S++){{1,{max_len}}}+(?:\s++\z)?+"), F.lit(0))
    short = (F.length(text) <= 2 * max_len) | ~text.rlike(r"\S")  # tokens are parted by one character at least
    return F.when(short, F.array(text)).otherwise(cut)


def pack(docs: DataFrame, max_len: int = 2048, buckets: int = 16, batch_tokens: int = 65_536, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per sequence: doc_id, text_key, copy, piece, text, n_tokens, bucket (its boundary), padding, batch_id, slot.

    batch_id numbers the batches of a bucket from 0, slot the sequences of a batch; no batch exceeds
    batch_tokens with its padding (unless one sequence alone does).
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    whole = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), hashed(text).alias("text_key"))
    part = F.pmod(hashed(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_key"), F.col("piece")), F.lit(PARTS)).cast("int")
    # lengths and parts, without texts: at most (max_len + 1) * PARTS rows after the counting
    last = F.greatest(F.lit(0), F.floor((F.col("n") - 1) / max_len)).cast("int")
    sized = whole.select("doc_id", "text_key", word_count(F.col("text")).cast("long").alias("n")).withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
    n_tokens = F.least(F.lit(max_len), F.col("n") - F.col("piece") * max_len).cast("int")
    sizes = written(sized.groupBy(n_tokens.alias("n_tokens"), part.alias("part")).count())
    counts = np.zeros(max_len + 1, np.int64)
    for r in sizes.groupBy("n_tokens").agg(F.sum("count")).collect():  # at most max_len + 1 rows
        counts[r[0]] = r[1]
    edges = boundaries(counts, buckets)
    bucket = F.lit(edges[-1] if edges else 0)
    for e in reversed(edges[:-1]):
        bucket = F.when(F.col("n_tokens") <= e, e).otherwise(bucket)
    parts = sizes.groupBy(bucket.alias("bucket"), "part").agg(F.sum("count").alias("count"))  # at most buckets * PARTS rows
    before = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("bucket", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    split = whole.withColumn("pieces", pieces_of(F.col("text"), max_len)).select("doc_id", "text_key", F.size("pieces").alias("of"), F.posexplode("pieces").alias("piece", "text"))
    rows = split.withColumn("n_tokens", F.when(F.col("piece") < F.col("of") - 1, max_len).otherwise(word_count(F.col("text"))).cast("int")).withColumns({"bucket": bucket, "part": part})
    order = Window.partitionBy("bucket", "part").orderBy("doc_id", "piece", "text_key")
    placed = rows.withColumns({"place": F.row_number().over(order), "copy": (F.row_number().over(order) - F.rank().over(order)).cast("int")})
    per = F.greatest(F.lit(1), F.floor(F.lit(batch_tokens) / F.greatest(F.col("bucket"), F.lit(1))))
    at = F.col("first") + F.col("place") - 1
    return placed.join(F.broadcast(starts), ["bucket", "part"]).select(
        "doc_id", "text_key", "copy", "piece", "text", "n_tokens", "bucket", (F.col("bucket") - F.col("n_tokens")).alias("padding"), F.floor(at / per).alias("batch_id"), F.pmod(at, per).cast("int").alias("slot")
    )
