"""Order MinHash fingerprints, from DataFrame functions alone.

A text's k-mers (k successive tokens; a token is a run of up to eight characters that are not white
space) are numbered by occurrence, so that the second time a k-mer comes it is another element than the first.
Each numbered k-mer gets a hash, whose leading bits deal it to one of TUPLES cells.  In each cell the LENGTH least
hashes are selected, put in the order in which their k-mers stand in the text, and hashed as a tuple: moved
passages change tuples as edits do, which plain MinHash does not see.  One hash with cells stands for as many permutations, which
would need as many hashes of each k-mer; a cell with too few k-mers borrows the tuple of another one (densification), which
it looks for in an order of its own, and a text without any full cell has the tuple of its least k-mers throughout.

All of it works within a row, on arrays, in four passes and two sorts; no k-mer becomes a row.  For the next document, rows are dealt to
blocks of neighbouring ids, whose bounds come from the sorted ids, so that blocks are of like size whatever the ids are.

Defined results: null texts count as empty; an empty text has the one k-mer of no tokens, so its fingerprint
equals that of other texts of white space; rows of equal ids follow each other in the order of their texts' hash, and each
is the other's next document; rows without an id have no next document (near_next 0, and edited with an empty text); the only row is its
own next document; an empty table gives an empty result; columns beside id and text are not read and may have any name.  Positions
count up to 2 ** 24 tokens, beyond which they start again: a longer text's tuples may be put in another order, the same one for equal texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 3
TUPLES, LENGTH = 32, 2
POSITION_BITS, HASH_BITS = 24, 39
CELL_BITS = 5  # TUPLES cells
#: Rows of a block of neighbouring ids, if that makes no more than MOST_BLOCKS (plus one for each partition of the sort of ids).
BLOCK_ROWS, MOST_BLOCKS = 256, 65_536
#: Bounds that one step of the search for a row's block looks through.
FAN = 256
NO_ID = -(1 << 63)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value worked out once."""
    return F.transform(F.array(value), body)[0]


def packed_hash(h: Column, position: Column) -> Column:
    kept = h.bitwiseAND(F.lit((1 << HASH_BITS) - 1))
    return F.shiftleft(kept, POSITION_BITS).bitwiseOR(position.cast("long").bitwiseAND(F.lit((1 << POSITION_BITS) - 1)))


def tuple_hash(kept: Column) -> Column:
    """32 bits of the hash of one or two kept k-mers' hashes, in the order of their positions."""
    position = lambda c: c.bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    own = lambda c: F.shiftright(c, POSITION_BITS)
    a, b = F.get(kept, F.lit(0)), F.get(kept, F.lit(1))
    swap = b.isNotNull() & (position(b) < position(a))
    return F.when(swap, F.xxhash64(own(b), own(a))).otherwise(F.xxhash64(own(a), own(b))).bitwiseAND(F.lit(0xFFFFFFFF))


def borrowed(own: Column, j: Column) -> Column:
    """The first tuple that is there in the order in which cell j looks through all cells."""
    step = F.pmod(j * 5, F.lit(TUPLES // 2)) * 2 + 1  # odd, so that every cell is met once
    return F.get(F.filter(F.transform(F.sequence(F.lit(1), F.lit(TUPLES - 1)), lambda i: F.get(own, F.pmod(j + i * step, F.lit(TUPLES)))), lambda x: x.isNotNull()), F.lit(0))


def signature(text: Column) -> Column:
    """array<bigint> of TUPLES tuple hashes of 32 bits."""
    last = lambda a: F.size(a) - 1
    grams = let(
        F.regexp_extract_all(text, F.lit(r"\S{1,8}"), F.lit(0)),
        lambda t: F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(t) - K, F.lit(0))),
            lambda i: packed_hash(F.xxhash64(*[F.get(t, i + j) for j in range(K)]), i),
        ),
    )
    # sorted by k-mer and position; a run of equal k-mers starts where the neighbour before differs
    numbered = let(
        F.sort_array(grams),
        lambda p: let(
            F.filter(F.sequence(F.lit(0), last(p)), lambda i: (i == 0) | (F.shiftright(F.get(p, i), POSITION_BITS) != F.shiftright(F.get(p, i - 1), POSITION_BITS))),
            lambda s: F.when(
                F.size(s) == F.size(p), F.transform(p, lambda x: packed_hash(F.xxhash64(F.shiftright(x, POSITION_BITS), F.lit(1)), x))
            ).otherwise(
                F.zip_with(
                    p,
                    F.flatten(F.zip_with(s, F.concat(F.slice(s, F.lit(2), F.size(s)), F.array(F.size(p))), lambda a, b: F.sequence(F.lit(1), b - a))),
                    lambda x, o: packed_hash(F.xxhash64(F.shiftright(x, POSITION_BITS), o), x),
                )
            ),
        ),
    )
    cell = lambda x: F.shiftright(x, POSITION_BITS + HASH_BITS - CELL_BITS)

    def tuples(q: Column) -> Column:
        """q: numbered k-mers by hash, so that a cell's stand together and begin with its least."""
        least = F.filter(q, lambda x, i: (i < LENGTH) | (cell(x) != cell(F.get(q, i - LENGTH))))
        cells = F.sequence(F.lit(0), F.lit(TUPLES - 1))

        def made(m: Column) -> Column:
            all_full = F.transform(cells, lambda j: tuple_hash(F.slice(m, j * LENGTH + 1, F.lit(LENGTH))))
            one = lambda j: let(F.filter(m, lambda x: cell(x) == j), lambda c: F.when(F.size(c) == LENGTH, tuple_hash(c)))
            rest = tuple_hash(F.slice(q, 1, LENGTH))
            some = let(F.transform(cells, one), lambda own: F.transform(cells, lambda j: F.coalesce(F.get(own, j), borrowed(own, j), rest)))
            return F.when(F.size(m) == TUPLES * LENGTH, all_full).otherwise(some)

        return let(least, made)

    return let(F.sort_array(numbered), tuples)


def as_text(sig: Column) -> Column:
    return F.array_join(F.transform(sig, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of tuples that agree."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.lit(TUPLES)


def edited(text: Column, following: Column) -> Column:
    """The last half of a text (rounded down) replaced by the first as many characters, or all, of another."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def block_bounds(rows: DataFrame) -> list[tuple[int, int]]:
    """(id, th) of the first row of each block, in order: every BLOCK_ROWS-th of each range of the sorted ids."""
    n = rows.count()
    every = max(BLOCK_ROWS, -(-n // MOST_BLOCKS))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.select("id", "th").repartitionByRange(parts, "id", "th").sortWithinPartitions("id", "th")
    # the last 33 bits count the rows of a partition, in its order
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    firsts = ordered.withColumn("place", place).filter(F.pmod("place", F.lit(every)) == 0).select("id", "th")
    return sorted({(r["id"], r["th"]) for r in firsts.collect()})


def in_blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (block, ghost, doc_id, th, text) in blocks of neighbouring ids; the first row of the next block comes along as a ghost, last."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("th"), "text")
    bounds = block_bounds(rows) or [(0, 0)]
    pair = "struct<id: bigint, th: bigint>"
    coarse = [bounds[i] for i in range(0, len(bounds), FAN)]
    fine = spark.createDataFrame([(c, bounds[c * FAN : (c + 1) * FAN]) for c in range(len(coarse))], f"coarse int, fine array<{pair}>")  # as many rows as coarse bounds
    key = F.struct("id", "th")
    upto = lambda array: F.greatest(F.lit(1), F.size(F.filter(array, lambda b: b <= key))) - 1
    coarse_bounds = F.array(*[F.struct(F.lit(i).cast("long").alias("id"), F.lit(t).cast("long").alias("th")) for i, t in coarse])
    placed = rows.withColumn("coarse", upto(coarse_bounds)).join(F.broadcast(fine), "coarse").withColumn("block", F.col("coarse") * FAN + upto(F.col("fine")))
    # the row after a block's last one: the first of the next block that has an id, and after the very last the first of all
    first = rows.filter(F.col("doc_id").isNotNull()).agg(F.min(key)).first()[0]
    follow = [(b - 1, *bounds[b]) for b in range(1, len(bounds)) if bounds[b][0] != NO_ID]
    follow += [(len(bounds) - 1, *first)] if first else []
    before = spark.createDataFrame(follow, "block int, id long, th long")
    ghosts = rows.join(F.broadcast(before), ["id", "th"]).groupBy("block").agg(F.first("doc_id").alias("doc_id"), F.first("th").alias("th"), F.first("text").alias("text"))
    return placed.select("block", F.lit(0).alias("ghost"), "doc_id", "th", "text").unionByName(ghosts.select("block", F.lit(1).alias("ghost"), "doc_id", "th", "text"))


def fingerprint_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The texts are shuffled once, by block of neighbouring ids; both windows share that order.
    """
    rows = in_blocks(docs, id_col, text_col)
    order = Window.partitionBy("block").orderBy("ghost", "doc_id", "th")
    following = F.when(F.col("doc_id").isNotNull(), F.lead("text").over(order))
    paired = rows.withColumn("following", F.coalesce(following, F.lit(""))).withColumn("edited", edited(F.col("text"), F.col("following")))
    signed = paired.select(
        "block", "ghost", "doc_id", "th", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        signature(F.col("text")).alias("own"), signature(F.col("edited")).alias("changed"),
    )
    beside = signed.withColumn("next", F.when(F.col("doc_id").isNotNull(), F.lead("own").over(order))).filter("ghost = 0")
    return beside.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"), as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"), F.coalesce(likeness(F.col("own"), F.col("next")), F.lit(0.0)).alias("near_next"),
    )
