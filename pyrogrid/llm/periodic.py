"""Periodic runs of words, found on an enhanced suffix array by the branching-tandem test.

The words of a text become numbers; a suffix array, its inverse (ISA) and its common prefixes (LCP) hold the order of all suffixes.  For each LCP
interval of depth d the suffixes of all children but the largest are asked whether ISA[i + d] or ISA[i - d] lies in the interval too: then
T[i:i+d] stands twice in a row, and where the next words differ the square branches, so that no square of its period stands one word on.
Every run has exactly one branching square of its period, at its end.  Rotating it to the left as long as the words agree gives the whole run.
Runs of a period that is a multiple of a smaller one have the same bounds as those of the smaller one and merge into them.

Intervals are found from minima over the LCP array, no tree is built.  The suffix array is made by prefix doubling of the suffixes that are not told apart
yet; the ranks of each doubling give common prefixes and rotations in steps of powers of two.  Several texts share one array, each with
words of its own and a last word that nothing else has, so no run crosses texts; a text of more than UNIT words has an array of its own.

Defined results: words are split at ASCII white space and nothing else; null and empty texts have no words and no run, and collapse to an
empty text; a very long text is handled whole, by one task, in memory of some 4 * log2(longest repeat) + 100 bytes a word; repeated rows are each
handled; ties do not arise here; an empty table gives an empty result; a null id stays null; other columns are not read and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

MIN_LENGTH, MIN_EXPONENT = 6, 4
#: Words of the texts that share a suffix array.
UNIT = 1 << 18

#: What separates words.
SPACE = r"[\x20\x09-\x0D]+"


def ranked(t: np.ndarray) -> list[np.ndarray]:
    """Ranks of all runs of 1, 2, 4, ... symbols, equal for equal runs and in their order, until all are told apart."""
    n = len(t)
    order = np.argsort(t, kind="stable")
    head = np.flatnonzero(np.diff(t[order], prepend=t[order[:1]] - 1))
    rank = np.empty(n, np.int32)
    rank[order] = np.repeat(head, np.diff(head, append=n))
    levels, step = [rank], 1
    live = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
    while len(live):
        follows = np.where(live + step < n, rank[np.minimum(live + step, n - 1)] + 1, 0)
        key = rank[live].astype(np.int64) * (n + 1) + follows
        order = np.argsort(key)
        live, key = live[order], key[order]
        new = np.diff(key, prepend=-1) != 0
        group = np.diff(key // (n + 1), prepend=-1) != 0
        at = np.arange(len(live))
        # a part of a group begins as many places behind the group's rank as it begins behind the group here
        offset = np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        rank = rank.copy()
        rank[live] += offset.astype(np.int32)
        levels.append(rank)
        alone = new & np.append(new[1:], True)
        live, step = live[~alone], step * 2
    return levels


def common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of suffixes a and b."""
    n, found = len(levels[0]), np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + found, b + found
        inside = np.maximum(x, y) < n
        same = inside & (levels[k][np.minimum(x, n - 1)] == levels[k][np.minimum(y, n - 1)])
        found[same] += 1 << k
    return found


def rotated(levels: list[np.ndarray], start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """How many places each square can be rotated to the left."""
    found = np.zeros(len(start), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x = start - found - (1 << k)
        same = (x >= 0) & (levels[k][np.maximum(x, 0)] == levels[k][np.maximum(x, 0) + period])
        found[same] += 1 << k
    return found


def intervals(lcp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of the LCP interval that each of the entries at (all above 0) belongs to."""
    n, depth = len(lcp), lcp[at]
    zeros = np.flatnonzero(np.concatenate([[True], lcp[1:] == 0, [True]]))
    longest = int(np.diff(zeros).max())
    least, tables = lcp, []
    while True:
        tables.append(least)  # minima of 2 ** k entries from each place on
        half = 1 << (len(tables) - 1)
        if 2 * half > longest or half >= n:
            break
        least = np.minimum(least, np.append(least[half:], np.zeros(half, lcp.dtype)))
    first, last = at.copy(), at.copy()
    for k in range(len(tables) - 1, -1, -1):
        width = 1 << k
        on = np.minimum(last + 1, n - 1)
        last[(last + width < n) & (tables[k][on] >= depth)] += width
        back = first - width
        first[(back >= 0) & (tables[k][np.maximum(back, 0)] >= depth)] -= width
    return first - 1, last


def runs_of(t: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of the runs of t, by start, then period; t ends with a symbol that stands nowhere else."""
    none = (np.zeros(0, np.int64),) * 3
    if len(t) < 2:
        return none
    levels = ranked(t)
    isa = levels[-1]
    sa = np.empty(len(t), np.int64)
    sa[isa] = np.arange(len(t))
    lcp = np.zeros(len(t), np.int32)
    met = np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]]) + 1
    if not len(met):
        return none
    lcp[met] = common(levels, sa[met - 1], sa[met])
    lo, hi = intervals(lcp, met)
    # the entries of an interval cut it into children
    order = np.lexsort((met, hi, lo))
    met, lo, hi = met[order], lo[order], hi[order]
    new = np.concatenate([[True], (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])])
    number = np.cumsum(new) - 1
    left = np.where(new, lo, np.append(0, met[:-1]))
    last = np.flatnonzero(np.append(new[1:], True))
    start, size = np.append(left, met[last]), np.append(met - left, hi[last] + 1 - met[last])
    owner, depth, lo, hi = np.append(number, number[last]), lcp[met[last]].astype(np.int64), lo[last], hi[last]
    order = np.lexsort((size, owner))
    small = order[:-1][owner[order][:-1] == owner[order][1:]]  # all children of an interval but the last, largest one
    start, size, owner = start[small], size[small], owner[small]
    place = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
    owner = np.repeat(owner, size)
    i, d, lo, hi = sa[place], depth[owner], lo[owner], hi[owner]
    squares = []
    for shift in (0, 1):
        first = i - shift * d  # the square begins here, its second half d on
        other = np.minimum(first + d, len(t) - 1) if not shift else np.maximum(first, 0)
        inside = (first >= 0) & (isa[other] >= lo) & (isa[other] <= hi)
        first, period = first[inside], d[inside]
        branches = t[first + period] != t[first + 2 * period]
        squares.append(np.stack([first[branches], period[branches]]))
    first, period = np.unique(np.concatenate(squares, axis=1), axis=1)
    back = rotated(levels, first, period)
    start, length = first - back, back + 2 * period
    long = length >= np.maximum(min_length, min_exponent * period)
    start, length, period = start[long], length[long], period[long]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    one = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1]))[: len(start)]
    start, length, period = start[one], length[one], period[one]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def collapsed(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by a space."""
    if len(start):
        kept = np.ones(len(words), bool)
        for s, n, q in zip(start.tolist(), length.tolist(), period.tolist(), strict=True):
            kept[s + q : s + n] = False
        words = [words[i] for i in np.flatnonzero(kept)]
    return b" ".join(words)


def _unit(texts: list[list[bytes]], min_length: int, min_exponent: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The runs of each text."""
    symbols, base = [], 0
    for words in texts:
        known: dict[bytes, int] = {}
        symbols.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)) + base)
        symbols.append(np.array([base + len(known)]))
        base += len(known) + 1
    start, length, period = runs_of(np.concatenate(symbols), min_length, min_exponent)
    bounds = np.append(0, np.cumsum([len(w) + 1 for w in texts]))
    cut = np.searchsorted(start, bounds)
    return [(start[a:b] - at, length[a:b], period[a:b]) for a, b, at in zip(cut, cut[1:], bounds, strict=False)]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Per row of docs: its id as doc_id, n_words, runs (start, length, period; by start, then period) and collapsed, the text without what runs repeat.

    A run is a longest stretch of words of one smallest period that holds it ``min_exponent`` times at least and has ``min_length`` words or more.
    """
    if min_exponent < 2:
        raise ValueError("a run holds its period twice at least")
    kind = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def made(texts: list[list[bytes]]) -> tuple[pa.Array, pa.Array]:
        found = _unit(texts, min_length, min_exponent) if texts else []
        columns = [pa.array(np.concatenate([f[k] for f in found]) if found else [], pa.int64()) for k in range(3)]
        offsets = pa.array(np.append(0, np.cumsum([len(f[0]) for f in found])), pa.int32())
        runs = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, fields=list(kind)))
        return runs, pa.array([collapsed(w, *f) for w, f in zip(texts, found, strict=True)], pa.binary()).cast(pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, held, first = [], 0, 0
            data = b.column(1).cast(pa.binary()).to_pylist()
            for i, text in enumerate(data):
                texts.append((text or b"").split())
                held += len(texts[-1])
                if held >= UNIT or i == len(data) - 1:
                    n = pa.array([len(w) for w in texts], pa.int64())
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(texts)), n, *made(texts)], names=["doc_id", "n_words", "runs", "collapsed"])
                    texts, held, first = [], 0, i + 1

    rows = small_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text as op13 judges them: one text in ten, told by crc32 of the id, goes on in copies of a stretch of its own from some word on."""
    h = F.crc32(F.col(id_col).cast("string"))
    words = F.when(h % 10 == 0, F.filter(F.split(text_col, SPACE), lambda w: w != ""))
    cut = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.floor(h / 10).cast("long").alias("g"), words.alias("words"))
    n = F.greatest(F.size("words"), F.lit(1))
    sized = cut.select("*", n.alias("n"), (F.col("g") % n).cast("int").alias("a"), (3 + F.col("g") % 8).cast("int").alias("times"))
    p = F.floor((F.col("n") - F.col("a")) / F.col("times")).cast("int") + 1
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, p), F.col("times"))), F.lit(1), F.col("n") - F.col("a"))
    made = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return sized.select("doc_id", F.when(F.size("words") > 0, made).otherwise(F.col("text")).alias("text"))
