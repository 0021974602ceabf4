"""Exact substring dedup: every byte covered by a 400-byte string that starts more than once is removed.

Three steps, each of which keeps every repeated string:

1. Content anchors (``anchors``) narrow the search: equal strings share their anchor's 150-byte gram.
   Grams are counted over the whole corpus; one that occurs once rules out all strings that it anchors.  The contexts of a shared
   gram (all that its strings cover) are counted too: equal ones go on as one, which stands for two copies from then on.
2. The contexts of a gram are sorted out by the collection's suffixes, whether they are copies or differ.
   The owned starts are cut into runs of 8 by their distance from the anchor; all strings of a run share
   a core of 393 bytes, so a run is a short sequence: up to 7 bytes, the core as one symbol, up to 7 bytes.  Column-wise construction
   (``bwt``) inserts one symbol of each sequence a round and updates transform and common prefixes in files; a common
   prefix of 8 symbols marks a repeated 400-byte string.  Cores are told apart by their bytes.
3. The repeated strings' extents meet the texts again, and what they cover is cut out.

A gram with over UNIT different contexts is spread over tasks: its runs become rows that are dealt by a hash of their core, and the
construction takes those.  A core which again has over UNIT different surroundings has its runs cut into narrower ones, whose cores hold more, until
each has fewer: all repeated strings come from the construction.

A View says in which bytes strings are sought and how long they are: 400 bytes of the text itself (BYTES), or 51 words (PASSAGES),
each of which stands in the string as five bytes of its hash; anchors of words are 13 words.  One search takes several views.

The construction runs over these short sequences, not over whole documents: there it needs as many rounds as the
longest document has bytes and rewrites all of the transform in each.

Defined results: null texts count as empty; texts shorter than a string lose nothing; very long texts are read in pieces that overlap by a
string; matches lie within documents; repeated rows are copies of each other, so all they have in long strings goes; an empty table gives
an empty result; ties do not arise; further columns pass through, whatever their names.  Grams and contexts are told apart by two hashes of 64
bits, cores and surroundings of spread grams by two, rows by one.
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import anchors as an
from . import bwt
from .common import dropped, looked_up, small_batches, unused, written

#: Starts of one run of a gram that is spread over tasks.
SPREAD_RUN = 25
#: Contexts of one gram and sequences of one core that one task takes; sequences of one construction (but a core's stay together).
UNIT, COLLECTION = 512, 16_384
#: Contexts that a task holds before it decides on them.
HELD = 2048
#: Bytes of texts whose anchors are sought at a time.
GROUP = 1 << 16
#: Bytes of a word's hash that stand for it in a view of words.
CODE = 5
_ODD_SPACE = re.compile(b"|".join(re.escape(c.encode()) for c in map(chr, range(0x80, 0x3001)) if c.isspace()))
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 28, 29, 30, 31, 32])


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and last byte (not included) of each word: what white space parts; ideographs and kana are words of their own."""
    x = np.frombuffer(_ODD_SPACE.sub(lambda m: b" " * len(m[0]), data), np.uint8)
    white = np.append(_SPACE[x], True)
    own = np.append((x >= 0xE3) & (x <= 0xE9), False)  # the first of three bytes
    after = np.concatenate([np.zeros(3, bool), own[:-3]])[: len(own)] if len(own) > 3 else np.zeros(len(own), bool)
    fresh = np.concatenate([[True], white[:-1]]) | own | after
    starts = np.flatnonzero(fresh & ~white)
    stops = np.flatnonzero(~np.concatenate([[True], white[:-1]]) & (fresh | white))
    return starts, stops


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte and hash of each word."""
    starts, stops = words_of(data)
    return starts, an.Hashes(np.frombuffer(data, np.uint8)).of(starts, stops)


def as_codes(data: bytes) -> bytes:
    """Each word as CODE bytes of its hash."""
    return np.ascontiguousarray(word_hashes(data)[1][:, None].view(np.uint8)[:, :CODE]).tobytes()


def of_codes(data: bytes, extents: np.ndarray) -> np.ndarray:
    """Extents in as_codes(data), as rows of start and stop, as extents in data, from a first word to the end of a last one."""
    starts, stops = words_of(data)
    first, last = -(-extents[:, 0] // CODE), extents[:, 1] // CODE
    return np.stack([starts[first], stops[last - 1]], axis=1)


def bytes_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.array([len(x) for x in texts], np.int64)


def hashes_of_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    starts, h = word_hashes(b"\n".join(texts))
    ends = np.cumsum([len(x) + 1 for x in texts])
    return h, np.diff(np.searchsorted(starts, ends), prepend=0)


@dataclass(frozen=True)
class View:
    """Strings of length bytes of seen(data); back leads extents there to extents in data; shorter data than least bytes holds no string.

    units gives the texts' units of ``unit`` bytes there, and how many each text has; strings start with a unit, anchors have gram units.
    The construction takes ``run`` starts of seen(data) at a time.
    """

    length: int
    least: int
    seen: Callable[[bytes], bytes]
    back: Callable[[bytes, np.ndarray], np.ndarray]
    units: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]
    unit: int
    gram: int
    run: int


BYTES = View(an.LENGTH, an.LENGTH, lambda data: data, lambda data, extents: extents, bytes_of, 1, an.GRAM, 8)
#: Every passage of over 50 words, however short the words are.
PASSAGES = View(51 * CODE, 101, as_codes, of_codes, hashes_of_words, CODE, 13, 2 * CODE)


def _groups(rids: np.ndarray, texts: list[bytes]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Texts that are handled at a time: of GROUP bytes together, so that the arrays stay in the cache; a longer one by itself."""
    lo = size = 0
    for i, x in enumerate(texts):
        if i > lo and size + len(x) > GROUP:
            yield rids[lo:i], texts[lo:i]
            lo, size = i, 0
        size += len(x)
    if lo < len(texts):
        yield rids[lo:], texts[lo:]


def _anchor_rows(views: list[View]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for rids, texts in _groups(b.column(0).to_numpy(), b.column(1).to_pylist()):
                for v, view in enumerate(views):
                    text, at, first, last, a, e = an.of_texts(*view.units(texts), view.length // view.unit, view.gram)
                    loc = at * view.unit << 24 | v << 16 | (at - first) * view.unit << 8 | (last - first) * view.unit
                    out.append((rids[text], loc, a.view(np.int64), e.view(np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["rid", "loc", "a", "e"])

    return run


def runs_of(context: bytes, back: int, span: int, run: int, length: int = an.LENGTH) -> list[tuple[int, bytes, bytes, bytes]]:
    """An anchor's runs, from the bytes of its context: first distance of the run, bytes before the core, the core, bytes after it.

    back is the distance of the context's first start from the anchor, span that of its last start from the first.
    """
    out = []
    for base in range((back - span) // run * run, back + 1, run):
        far, near = min(back, base + run - 1), max(back - span, base)
        lo, hi = back - base, back - base + length - run + 1
        out.append((base, context[back - far : lo], context[lo:hi], context[hi : back - near + length]))
    return out


def _contexts(views: list[View]):
    """Of rows with __text, __locs, __as, __es, __ns, __spread: the contexts' bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, *lists in zip(*(b.column(c).to_pylist() for c in ("__text", "__locs", "__as", "__es", "__ns", "__spread")), strict=True):
                data, seen = (text or "").encode("utf-8"), {}
                for loc, a, e, n, spread in zip(*lists, strict=True):
                    at, v, back, span = loc >> 24, loc >> 16 & 255, loc >> 8 & 255, loc & 255
                    if v not in seen:
                        seen[v] = views[v].seen(data)
                    rows.append((a, e, min(n, 2), v, back, span, seen[v][at - back : at - back + span + views[v].length], spread))
            yield _batch(rows, CONTEXTS)

    return run


def _spread_runs(views: list[View]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The runs of rows of CONTEXTS."""
        for b in batches:
            rows = []
            for a, e, n, v, back, span, context, _ in zip(*(c.to_pylist() for c in b.columns), strict=True):
                rows += [(a, e, n, base, core, len(left), left + right) for base, left, core, right in runs_of(context, back, span, SPREAD_RUN, views[v].length)]
            yield _batch(rows, SPREAD)

    return run


#: Columns of contexts, and of the runs of grams that are spread.
CONTEXTS = (("a", pa.int64()), ("e", pa.int64()), ("n", pa.int32()), ("v", pa.int32()), ("back", pa.int32()), ("span", pa.int32()), ("context", pa.binary()), ("spread", pa.bool_()))
SPREAD = (("a", pa.int64()), ("e", pa.int64()), ("n", pa.int32()), ("base", pa.int32()), ("core", pa.binary()), ("before", pa.int32()), ("around", pa.binary()))
_SQL = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary", pa.bool_(): "boolean"}


def schema_of(columns: tuple) -> str:
    return ", ".join(f"{c} {_SQL[k]}" for c, k in columns)


def _batch(rows: list[tuple], columns: tuple) -> pa.RecordBatch:
    names, kinds = zip(*columns, strict=True)
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=list(names))


@dataclass(frozen=True)
class Runs:
    """Runs as sequences: n_left bytes of data that end before left, the core's symbol, n_right bytes from right on."""

    owner: np.ndarray
    copies: np.ndarray
    base: np.ndarray
    symbol: np.ndarray
    data: np.ndarray
    left: np.ndarray
    n_left: np.ndarray
    right: np.ndarray
    n_right: np.ndarray


def decided(x: Runs, run: int, near: np.ndarray, far: np.ndarray) -> None:
    """Let the construction find the repeated strings of runs and widen near and far of their owners by the strings' distances.

    A core that only one sequence has rules that out; the others are dealt to constructions of COLLECTION sequences, a core's together.
    """
    order = np.argsort(x.symbol, kind="stable")
    order = order[np.bincount(x.symbol, x.copies)[x.symbol[order]] > 1]
    data, column = np.append(x.data, np.uint8(0)), np.arange(2 * run)
    lo = 0
    while lo < len(order):
        hi = min(lo + COLLECTION, len(order))
        while hi < len(order) and x.symbol[order[hi]] == x.symbol[order[hi - 1]]:
            hi += 1
        mine = order[lo:hi]
        rank = np.cumsum(np.diff(x.symbol[mine], prepend=x.symbol[mine[0]]) > 0)  # the cores' numbers in this construction
        after, sizes = x.n_right[mine][:, None], x.n_left[mine] + 1 + x.n_right[mine]
        # from the right: the bytes after the core, the core, the bytes before it
        at = np.where(column < after, x.right[mine][:, None] + after - 1 - column, x.left[mine][:, None] + after - column)
        rows = data[np.clip(at, 0, len(x.data))].astype(np.uint16) + np.uint16(1)  # bytes are symbols from 1 on
        rows[column >= sizes[:, None]] = bwt.END
        rows[np.arange(len(mine)), x.n_right[mine]] = 257 + rank
        with tempfile.TemporaryDirectory() as folder:
            seq, start = bwt.repeated(rows, sizes, run, Path(folder), x.copies[mine])
        j = mine[seq]
        d = x.base[j] + x.n_left[j] - start
        np.minimum.at(near, x.owner[j], d)
        np.maximum.at(far, x.owner[j], d)
        lo = hi


FOUND = "a long, e long, near int, far int"


def _emitted(ids: list, near: np.ndarray, far: np.ndarray) -> pa.RecordBatch:
    found = np.flatnonzero(far >= 0)
    return pa.RecordBatch.from_arrays([
        *(pa.array([ids[i][k] for i in found.tolist()], pa.int64()) for k in (0, 1)), pa.array(near[found].astype(np.int32)), pa.array(far[found].astype(np.int32)),
    ], names=["a", "e", "near", "far"])


def context_runs(view: View, copies: np.ndarray, back: np.ndarray, span: np.ndarray, contexts: list[bytes]) -> Runs:
    """Contexts' runs (as runs_of cuts them) whose core another run or another copy has: hashes rule the others out, bytes tell the cores apart."""
    run, data = view.run, b"".join(contexts)
    lowest = (back - span) // run
    count = back // run - lowest + 1
    owner = np.repeat(np.arange(len(contexts)), count)
    base = (lowest[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * run
    begin = np.cumsum([0] + [len(c) for c in contexts[:-1]])
    left = begin[owner] + back[owner] - base
    right = left + view.length - run + 1
    x = np.frombuffer(data, np.uint8)
    same = np.unique(an.Hashes(x).of(left, right) ^ an.mixed(base.astype(np.uint64)), return_inverse=True)[1]
    kept = np.flatnonzero(np.bincount(same, copies[owner])[same] > 1)
    owner, base, left, right = owner[kept], base[kept], left[kept], right[kept]
    names: dict = {}
    symbol = [names.setdefault((b, data[i:j]), len(names)) for b, i, j in zip(base.tolist(), left.tolist(), right.tolist(), strict=True)]
    n_left = np.minimum(back[owner], base + run - 1) - base
    n_right = base + run - 1 - np.maximum(back[owner] - span[owner], base)
    return Runs(owner, copies[owner], base, np.array(symbol, np.int64), x, left, n_left, right, n_right)


def _of_contexts(views: list[View]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of CONTEXTS, a view's and in it a gram's together: per context the least and greatest distance of its repeated strings."""

        def decide(rows: list[tuple]) -> pa.RecordBatch:
            view = views[rows[0][3]]
            near, far = np.full(len(rows), 1 << 30), np.full(len(rows), -1)
            copies, back, span = (np.array([r[k] for r in rows], np.int64) for k in (2, 4, 5))
            decided(context_runs(view, copies, back, span, [r[6] for r in rows]), view.run, near, far)
            return _emitted(rows, near, far)

        held: list[tuple] = []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held and (row[3] != held[-1][3] or (len(held) >= HELD and row[0] != held[-1][0])):
                    yield decide(held)
                    held = []
                held.append(row)
        if held:
            yield decide(held)

    return run


def _of_runs(run: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (k, k2, n, base, r, r2, before, around), a core's (k, k2) together: per sequence (r, r2) least and greatest distance."""

        def decide(rows: list[tuple]) -> pa.RecordBatch:
            near, far = np.full(len(rows), 1 << 30), np.full(len(rows), -1)
            names: dict = {}
            symbol = np.array([names.setdefault(r[:2], len(names)) for r in rows], np.int64)
            copies, base, before, size = (np.array(c, np.int64) for c in zip(*((r[2], r[3], r[6], len(r[7])) for r in rows), strict=True))
            left = np.cumsum(size) - size + before
            data = np.frombuffer(b"".join(r[7] for r in rows), np.uint8)
            decided(Runs(np.arange(len(rows)), copies, base, symbol, data, left, before, left, size - before), run, near, far)
            return _emitted([r[4:6] for r in rows], near, far)

        held: list[tuple] = []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if len(held) >= HELD and row[:2] != held[-1][:2]:
                    yield decide(held)
                    held = []
                held.append(row)
        if held:
            yield decide(held)

    return each


def _two(name: str, *c: str | Column) -> dict[str, Column]:
    return {name: F.xxhash64(*c), f"{name}2": F.xxhash64(F.lit(1), *c)}


def _narrower(runs: DataFrame, run: int, part: int) -> DataFrame:
    """Runs of ``run`` string starts cut into such of ``part`` starts: what all strings of one of these have beside the core belongs to its own core."""
    at, size = F.col("at"), F.length("around") - F.col("before")
    each = runs.withColumn("at", F.explode(F.array(*[F.lit(x) for x in range(0, run, part)])))
    # starts are told by how many bytes they lie before the core: from nearest to before there are strings
    nearest = run - 1 - size
    more = F.least(F.col("before"), at + part - 1) - at
    after = at + part - 1 - F.greatest(nearest, at)
    own = F.substring("around", F.col("before") - at + 1, F.lit(run - part))
    left, right = F.substring("around", F.col("before") - at - more + 1, more), F.substring("around", F.col("before") + (run - part) - at + 1, after)
    cut = each.filter((at <= F.col("before")) & (nearest <= at + part - 1)).select(
        F.col("r").alias("a"), F.col("r2").alias("e"), "n", (F.col("base") + at).cast("int").alias("base"), "k", "k2", own.alias("own"), more.cast("int").alias("before"), F.concat(left, right).alias("around")
    )
    return cut.withColumns(_two("__k", "k", "k2", "base", "own")).drop("k", "k2", "own").withColumnsRenamed({"__k": "k", "__k2": "k2"})


def repeated_in_runs(runs: DataFrame, run: int = SPREAD_RUN) -> DataFrame:
    """Per owner a, e of runs (a, e, n, base, k, k2, before, around), near, far: least and greatest distance from the anchor of starts of repeated strings.

    Every core goes through the construction.  One that stands in over UNIT different surroundings has its runs cut into narrower ones first, whose cores
    hold some of what surrounded it; at the latest in runs of one string nothing surrounds the core.
    """
    named = runs.withColumns(_two("r", "k", "k2", "before", "around"))
    reads = written(named.groupBy("k", "k2", "base", "r", "r2", "before", "around").agg(F.least(F.lit(2), F.sum("n")).cast("int").alias("n")))
    units = reads.groupBy("k", "k2").agg(F.count("*").alias("size"), F.sum("n").alias("copies")).filter("copies > 1")
    shared = written(looked_up(reads, units, ["k", "k2"]))  # a very common core is salted
    parts = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # not fewer for few bytes: the work is in the rounds
    few = shared.filter(F.col("size") <= UNIT).select("k", "k2", "n", "base", "r", "r2", "before", "around").repartition(parts, "k").sortWithinPartitions("k", "k2")
    found = few.mapInArrow(_of_runs(run), FOUND)
    many = shared.filter(F.col("size") > UNIT)
    if run > 1 and many.take(1):
        part = max(x for x in range(1, run) if run % x == 0)
        found = found.unionByName(repeated_in_runs(_narrower(many, run, part), part))
    one = written(found.groupBy(F.col("a").alias("r"), F.col("e").alias("r2")).agg(F.min("near").alias("near"), F.max("far").alias("far")))
    return looked_up(named.select("a", "e", "r", "r2"), one, ["r", "r2"]).groupBy("a", "e").agg(F.min("near").alias("near"), F.max("far").alias("far"))


def _cut_out(view: View):
    def cut_out(text: pd.Series, extents: pd.Series) -> pd.DataFrame:
        out = []
        for data, ext in zip(text, extents, strict=True):
            kept, spans, removed, at = [], 0, 0, 0
            end = -1
            found = [] if ext is None or not len(ext) else sorted(view.back(data, np.asarray(ext, np.int64).reshape(-1, 2)).tolist())
            for start, stop in found:
                if start > end:  # extents that touch are one run
                    spans += 1
                    kept.append(data[at:start])
                if stop > end:
                    removed += stop - max(start, end)
                    end = at = stop
            kept.append(data[at:])
            out.append((len(data), removed, spans, b"".join(kept)))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept"])

    return cut_out


CUT = "n_bytes long, n_removed long, n_spans long, kept binary"


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", view: View = BYTES, beside: dict[str, View] | None = None) -> DataFrame:
    """docs with a column __cut: struct of n_bytes, n_removed, n_spans and kept (the remaining bytes).

    Each view of beside is sought in the same search and gives a column of its own of that kind, by its name; it takes nothing from __cut.
    """
    spark, u = docs.sparkSession, unused(docs)
    views = {"__cut": view, **(beside or {})}
    each = list(views.values())
    data = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rid, ext = f"{u}rid", f"{u}extents"
    rows = small_batches(docs).withColumn(rid, F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), data))
    texts = rows.select(F.col(rid).alias("rid"), data.alias("data"))
    found = written(texts.filter(F.length("data") >= min(v.least for v in each)).mapInArrow(_anchor_rows(each), "rid long, loc long, a long, e long"))
    again = written(found.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1"))
    shared = written(looked_up(found, again, "a", rows="n").drop("n"))
    dropped(found)  # most anchors are not shared, and nothing below reads them
    named = written(shared.groupBy("a", "e").agg(F.count("*").alias("n"), F.first("rid").alias("rid"), F.first("loc").alias("loc")))
    many = named.groupBy("a").agg(F.count("*").alias("size")).filter(F.col("size") > UNIT).select("a", F.lit(True).alias("spread"))
    marked = looked_up(named, many, "a", "left").withColumn("spread", F.coalesce("spread", F.lit(False)))
    lists = [F.collect_list(c).alias(f"__{c}s") for c in ("loc", "a", "e", "n")]
    asked = marked.groupBy(F.col("rid").alias(rid)).agg(*lists, F.collect_list("spread").alias("__spread"))
    met = rows.join(asked, rid).dropDuplicates([rid]).withColumn("__text", F.col(text_col).cast("string"))
    contexts = written(met.mapInArrow(_contexts(each), schema_of(CONTEXTS)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = contexts.filter(~F.col("spread")).repartition(parts, "a").sortWithinPartitions("v", "a")
    found_in = whole.mapInArrow(_of_contexts(each), FOUND)
    spread = contexts.filter("spread")
    if spread.take(1):
        runs = spread.mapInArrow(_spread_runs(each), schema_of(SPREAD)).withColumns(_two("k", "core", "base")).drop("core")
        found_in = found_in.unionByName(repeated_in_runs(runs))
    repeats = written(found_in)
    at, v = F.shiftright("loc", 24), F.shiftright("loc", 16).bitwiseAND(255).cast("int")
    length = F.element_at(F.array(*[F.lit(x.length) for x in each]), v + 1)
    extents = looked_up(shared, repeats, ["a", "e"]).select("rid", v.alias("v"), (at - F.col("far")).alias("start"), (at - F.col("near") + length).alias("stop")).distinct()
    of_view = [F.flatten(F.collect_list(F.when(F.col("v") == i, F.array("start", "stop")))).alias(f"{ext}{i}") for i in range(len(each))]
    out = rows.join(extents.groupBy(F.col("rid").alias(rid)).agg(*of_view), rid, "left")
    for i, (name, x) in enumerate(views.items()):
        out = out.withColumn(name, F.pandas_udf(_cut_out(x), CUT)(data, F.col(f"{ext}{i}")))
    return out.drop(rid, *[f"{ext}{i}" for i in range(len(each))])
