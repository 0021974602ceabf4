"""Language identification by interpolated Kneser-Ney character models.

One model per language, all held in one sorted array of n-gram hashes for each order, with a row of
log2 probabilities per hash (a column per language).  A text gets the language whose
cross-entropy per character is lowest; it is rejected where even that exceeds what calibration texts
of like length show.

Training takes a bounded sample of labelled rows (``docs_per_lang`` distinct texts and ``chars_per_lang`` characters of each
language, chosen by a hash of the text, texts over ``max_chars`` left aside); more than ``max_langs`` languages raise, none is left out; every row
is scored whole, a very long one in pieces.  Letters are what Unicode calls so: digits, fractions and Roman numerals are none.

Defined results: a null text or one without letters gets ``und``, score 0 and rejection; rows without a language or text are not learned
from; without any to learn from every row gets ``und``; ties go to the smaller language name; repeated rows get equal results; an empty
table gives an empty result; columns of the input with the names of results are replaced by these, never read.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import looked_up, small_batches

ORDER = 4
UNIFORM = 1.0 / 4096
#: Characters scored at a time.
CHUNK = 1 << 19


def multipliers(order: int) -> np.ndarray:
    return np.random.default_rng(20_240_521).integers(1 << 20, 1 << 63, order, dtype=np.uint64) | np.uint64(1)


@cache
def patterns() -> tuple[re.Pattern, re.Pattern, re.Pattern]:
    """What may be a mark (any character beyond 16 bits among them); runs of what is no letter; and runs of what is neither letter nor mark, which takes longer.

    Marks are vowels and tones in many scripts, and part of their words.
    """
    marks = [i for i in range(sys.maxunicode + 1) if unicodedata.category(chr(i))[0] == "M"]
    ranges, lo = [], marks[0]
    for a, b in zip(marks, [*marks[1:], -1]):
        if b != a + 1:
            ranges.append(f"{chr(lo)}-{chr(a)}")
            lo = b
    every = "".join(ranges)
    short = "".join(r for r in ranges if r[2] <= "\uffff")
    return re.compile(f"[{short}]|[\U00010000-\U0010ffff]"), re.compile(r"[\W\d_]+"), re.compile(rf"(?:[^\w{every}]|[\d_])+")


def letters(text: str | None) -> str:
    """Lower-case letters, with their marks, and single spaces between words and around; empty without letters."""
    mark, plain, marked = patterns()
    text = (text or "").lower()
    if not text.isascii():  # numbers that are no digits, as fractions and Roman numerals, are no letters
        odd = {ord(c): " " for c in set(text) if c.isnumeric() and not c.isalpha()}
        text = text.translate(odd) if odd else text
    body = (plain if text.isascii() or not mark.search(text) else marked).sub(" ", text).strip()
    return f" {body} " if re.search(r"[^\W\d_]", body) else ""


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def grams(codes: np.ndarray, order: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Hashes of the n-grams that end at each character, and of their contexts, for n = 1 .. order."""
    m = multipliers(order)
    gram, context = [codes * m[0]], [np.zeros(len(codes), np.uint64)]
    for n in range(1, order):
        back = np.zeros(len(codes), np.uint64)
        back[n:] = codes[:-n] if n < len(codes) else back[n:]
        gram.append(gram[-1] + back * m[n])
        context.append(context[-1] + back * m[n])
    return gram, context


def lookup(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of wanted hashes in a sorted array, and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class KneserNey:
    """Probabilities of one language: at each order the sorted grams with what they get there."""

    def __init__(self, texts: list[str], order: int):
        # each text is preceded by spaces, so that no gram spans two texts
        codes = code_points("".join(" " * (order - 1) + t for t in texts))
        gram, context = grams(codes, order)
        keep = np.arange(len(codes))
        self.levels: list[tuple[np.ndarray, ...]] = [()] * order
        for n in reversed(range(order)):  # counts at the top, numbers of distinct left extensions below
            keys, first, counts = np.unique(gram[n][keep], return_index=True, return_counts=True)
            keep = keep[first]
            ctx, inv = np.unique(context[n][keep], return_inverse=True)
            total = np.bincount(inv, counts)
            one, two = int((counts == 1).sum()), int((counts == 2).sum())
            discount = min(0.95, max(0.05, one / (one + 2 * two) if one else 0.5))
            gamma = discount * np.bincount(inv) / total
            self.levels[n] = (keys, np.maximum(counts - discount, 0) / total[inv], gamma[inv], ctx, gamma, keep)
        lower = None
        for n, (keys, own, share, ctx, gamma, keep) in enumerate(self.levels):
            under = np.full(len(keys), UNIFORM) if n == 0 else lower[1][lookup(lower[0], gram[n - 1][keep])[0]]
            lower = (keys, own + share * under)
            self.levels[n] = (keys, lower[1], ctx, gamma, gram[n - 1][keep] if n else keys, context[n][keep])


class Model:
    """All languages in one sorted hash array per order, as rows of log2 probabilities."""

    def __init__(self, texts: dict[str, list[str]], order: int = ORDER):
        self.langs, self.order = sorted(texts), order
        each = [KneserNey(texts[x], order) for x in self.langs]
        self.grams, self.contexts = [], []
        floor = np.log2(UNIFORM)
        for n in range(order if each else 0):
            ctx = np.unique(np.concatenate([x.levels[n][2] for x in each]))
            back = np.zeros((len(ctx), len(each)), np.float32)
            for k, x in enumerate(each):
                at, known = lookup(x.levels[n][2], ctx)
                back[known, k] = np.log2(x.levels[n][3][at[known]])
            keys, first = np.unique(np.concatenate([x.levels[n][0] for x in each]), return_index=True)
            suffix = np.concatenate([x.levels[n][4] for x in each])[first]
            context = np.concatenate([x.levels[n][5] for x in each])[first]
            if n:
                rows = self.grams[n - 1][1][lookup(self.grams[n - 1][0], suffix)[0]]
            else:
                rows = np.full((len(keys), len(each)), floor, np.float32)
            rows = rows + back[lookup(ctx, context)[0]]
            for k, x in enumerate(each):
                at, known = lookup(x.levels[n][0], keys)
                rows[known, k] = np.log2(x.levels[n][1][at[known]])
            self.grams.append((keys, rows.astype(np.float32)))
            self.contexts.append((ctx, back))
        self.limits: np.ndarray | None = None

    def log2_rows(self, codes: np.ndarray) -> np.ndarray:
        """log2 probability of each character under each language."""
        gram, context = grams(codes, self.order)
        out = np.zeros((len(codes), len(self.langs)), np.float32)
        open_ = np.arange(len(codes))
        for n in reversed(range(self.order)):
            at, known = lookup(self.grams[n][0], gram[n][open_])
            out[open_[known]] += self.grams[n][1][at[known]]
            open_ = open_[~known]
            if not len(open_):
                return out
            at, known = lookup(self.contexts[n][0], context[n][open_])
            out[open_[known]] += self.contexts[n][1][at[known]]
        out[open_] += np.float32(np.log2(UNIFORM))
        return out

    def cross_entropy(self, texts: list[str]) -> np.ndarray:
        """Bits per character of each (letters-only) text under each language; inf for empty texts."""
        out = np.full((len(texts), len(self.langs)), np.inf)
        group: list[int] = []
        size = 0
        for i, t in enumerate(texts):
            if t:
                group.append(i)
                size += len(t)
            if size >= CHUNK or (i == len(texts) - 1 and group):
                out[group] = self._sums([texts[j] for j in group])
                group, size = [], 0
        return out

    def _sums(self, texts: list[str]) -> np.ndarray:
        lead = self.order - 1
        codes = code_points("".join(" " * lead + t for t in texts))
        lengths = np.array([len(t) + lead for t in texts])
        ends = np.cumsum(lengths)
        total = np.zeros((len(texts), len(self.langs)))
        for lo in range(0, len(codes), CHUNK):  # one very long text is scored in pieces that overlap by the context
            hi = min(lo + CHUNK, len(codes))
            rows = self.log2_rows(codes[max(0, lo - lead) : hi])[min(lead, lo) :]
            doc = np.searchsorted(ends, np.arange(lo, hi), "right")
            rows[np.arange(lo, hi) - (ends - lengths)[doc] < lead] = 0
            starts = np.flatnonzero(np.diff(doc, prepend=-1))
            total[doc[starts]] += np.add.reduceat(rows, starts, axis=0, dtype=np.float64)
        return -total / (lengths - lead)[:, None]

    def calibrate(self, texts: list[str], false_rejections: float, margin: float) -> None:
        """Set, by length (powers of two), what cross-entropy is still accepted."""
        h = self.cross_entropy(texts).min(axis=1, initial=np.inf) if self.langs else np.zeros(0)
        known = np.isfinite(h)
        size = np.array([len(t) for t in texts])[known] if len(texts) else np.zeros(0)
        limits = np.full(40, np.inf)
        for k in range(40):  # texts of half to double the length
            near = h[known][(size >= 2.0 ** (k - 1)) & (size < 2.0 ** (k + 2))]
            if len(near) >= 20:
                limits[k] = np.quantile(near, 1 - false_rejections) + margin
        # shorter texts vary more: none gets a stricter limit than longer ones have
        self.limits = np.maximum.accumulate(np.where(np.isfinite(limits), limits, -np.inf)[::-1])[::-1]
        self.limits[~np.isfinite(self.limits)] = np.inf

    def predict(self, texts: list[str | None]) -> dict[str, list]:
        clean = [letters(t) for t in texts]
        h = self.cross_entropy(clean) if self.langs else np.zeros((len(texts), 1))
        out: dict[str, list] = {"lang_pred": [], "score": [], "cross_entropy": [], "rejected": []}
        best = h.argmin(axis=1) if len(self.langs) else np.zeros(len(texts), int)
        for i, t in enumerate(clean):
            if not t or not self.langs:
                row = ("und", 0.0, None, True)
            else:
                low, n = h[i, best[i]], len(t) - 2
                score = 1.0 / np.exp2(-(h[i] - low) * min(n, 64)).sum()
                limit = self.limits[min(39, int(np.log2(n)))] if self.limits is not None else np.inf
                row = (self.langs[best[i]], float(score), float(low), bool(low > limit))
            for k, v in zip(out, row, strict=True):
                out[k].append(v)
        return out


def train(
    labelled: DataFrame,
    docs_per_lang: int = 400,
    chars_per_lang: int = 8_000_000,
    max_langs: int = 1000,
    max_chars: int = 200_000,
    order: int = ORDER,
    false_rejections: float = 0.001,
    margin: float = 1.0,
) -> Model:
    """Fit models on a bounded sample of (text, lang); a fifth of it sets the limits of rejection. More languages than max_langs raise: none is left out."""
    usable = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") <= max_chars)).select("text", "lang")
    usable = usable.withColumn("h", F.xxhash64("text"))
    # copies count once, and each language has a bound of its own, so that neither uses up another text's or language's part
    langs = usable.select("lang", "h").distinct().groupBy("lang").agg(F.count("*").alias("texts"))
    by: dict[str, list[str]] = {r["lang"]: [] for r in langs.limit(max_langs + 1).collect()}
    if len(by) > max_langs:
        raise ValueError(f"over {max_langs} languages")
    share = F.least(F.lit(1_000_000), 1 + F.floor(F.lit(docs_per_lang * 1_200_000) / F.col("texts")))
    drawn = looked_up(usable, langs, "lang").filter(F.pmod("h", F.lit(1_000_000)) < share).groupBy("lang", "h").agg(F.first("text").alias("text"))
    in_order = Window.partitionBy("lang").orderBy("h")
    # ordered by hash, so that the same rows give the same model
    sized = drawn.withColumns({"place": F.row_number().over(in_order), "upto": F.sum(F.length("text")).over(in_order)})
    for r in sized.filter((F.col("place") <= docs_per_lang) & (F.col("upto") <= chars_per_lang)).orderBy("lang", "h").select("lang", "text").collect():
        by[r["lang"]].append(letters(r["text"]))
    by = {k: [t for t in v if t] for k, v in by.items()}
    by = {k: v for k, v in by.items() if v}
    model = Model({k: [t for i, t in enumerate(v) if i % 5 or len(v) < 10] for k, v in by.items()}, order)
    model.calibrate([t for v in by.values() if len(v) >= 10 for t in v[::5]], false_rejections, margin)
    return model


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: id, the columns of keep, lang_pred, score (0 to 1), cross_entropy (bits a character), rejected."""
    made = {"lang_pred": pa.string(), "score": pa.float64(), "cross_entropy": pa.float64(), "rejected": pa.bool_()}
    columns = [c for c in dict.fromkeys((id_col, *keep)) if c.lower() not in made]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = shared.value.predict(b.column(len(columns)).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *(pa.array(got[k], t) for k, t in made.items())], names=[*columns, *made])

    rows = small_batches(docs).select(*columns, F.col(text_col).alias("__text"))
    return rows.mapInArrow(run, ", ".join(filter(None, [schema, "lang_pred string, score double, cross_entropy double, rejected boolean"])))
