"""The training-data operators against brute force, and on nulls, empty tables, ties and repeated rows."""

import collections
import hashlib
import itertools
import random
import re
import tempfile
import zlib
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from pyrogrid.llm import ann, balltree, bwt, chat, common, counttree, langid, mixing, neardup, ordermin, packing, periodic, queries, simhash, suffixdedup, toxicity, urlrep

DOCS = "doc_id long, text string"


def words(rng, n, size=300):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


# ---- joins that meet hot keys


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("most", [0, 1000])
def test_looked_up(spark, how, most):
    rows = [(1 if i % 3 else i, i) for i in range(3000)] + [(None, -1)]
    big, small = spark.createDataFrame(rows, "k long, v long"), spark.createDataFrame([(i, f"n{i}") for i in range(0, 3000, 2)] + [(1, "hot")], "k long, name string")
    got = sorted(map(str, common.looked_up(big, small, "k", how, most).select("k", "v", "name").collect()))
    assert got == sorted(map(str, big.join(small, "k", how).select("k", "v", "name").collect()))
    two = common.looked_up(big.withColumn("j", F.lit(1)), small.withColumn("j", F.lit(1)), ["k", "j"], how, most)
    assert sorted(map(str, two.select("k", "v", "name").collect())) == got


# ---- exact substring dedup


def brute_cut(texts):
    seen = {}
    for b in texts:
        for i in range(len(b) - 399):
            seen[b[i : i + 400]] = seen.get(b[i : i + 400], 0) + 1
    out = []
    for b in texts:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 399):
            if seen[b[i : i + 400]] > 1:
                gone[i : i + 400] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize(("unit", "held"), [(512, 2048), (3, 1), (1, 1)])
def test_suffix_dedup(spark, unit, held, monkeypatch):
    # few contexts to a task: the grams of this table are spread, and their cores too
    monkeypatch.setattr(suffixdedup, "UNIT", unit)
    monkeypatch.setattr(suffixdedup, "HELD", held)
    monkeypatch.setattr(suffixdedup, "COLLECTION", held)
    rng = random.Random(4)
    a, b = words(rng, 120), words(rng, 90) + " é"
    texts = [a, a, None, "", "x" * 399, "x" * 1500, words(rng, 40) + a[:401] + words(rng, 30), words(rng, 20) + b[:399] + words(rng, 9), b, a[3:405] + b]
    texts += [words(rng, 20) + a[50 : 50 + n] + words(rng, 20) for n in range(396, 430, 3)]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffixdedup.dedup(df).select("doc_id", "__cut.n_bytes", "__cut.n_removed", "__cut.n_spans", F.sha2("__cut.kept", 256)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_cut([(t or "").encode() for t in texts])
    assert suffixdedup.dedup(df.limit(0)).count() == 0


def brute_passages(texts, length=51):
    """Per text the words that no passage of so many words covers which starts more than once in all texts."""
    split = [(t or "").split() for t in texts]
    starts = [[hash(tuple(w[i : i + length])) for i in range(len(w) - length + 1)] for w in split]
    seen = collections.Counter(itertools.chain(*starts))
    out = []
    for w, mine in zip(split, starts):
        gone = np.zeros(len(w), bool)
        for i, h in enumerate(mine):
            if seen[h] > 1:
                gone[i : i + length] = True
        out.append([x for x, g in zip(w, gone) if not g])
    return out


def test_passages_of_51_words(spark):
    rng = random.Random(14)
    texts = [None, "", "z " * 50, "q", "\u3000".join(words(rng, 60, 9).split())]
    for size, n in itertools.product((9, 300, 10**12), (49, 50, 51, 52, 60)):  # from two letters a word to fourteen
        passage = words(rng, n, size)
        texts += [f"{words(rng, 20)} {passage} {words(rng, 20)}", f"{words(rng, 31)}\n{passage}  é{words(rng, 70)}"]
    texts += [texts[4].replace("\u3000", "\n"), "a b " * 60]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCS + ", lang string, source string, n_chars long")
    got = {r["doc_id"]: (r["text"] or "").split() for r in corpus_pipeline.substring_dedup(spark, docs, "").collect()}
    assert [got[i] for i in range(len(texts))] == brute_passages(texts)
    unspaced = suffixdedup.words_of("ab漢字c \u00a0é".encode())
    assert [x.tolist() for x in unspaced] == [[0, 2, 5, 8, 12], [2, 5, 8, 9, 14]]


def test_suffix_dedup_with_passages_beside(spark, monkeypatch):
    """op2's own columns are the 400 bytes' alone; passages of over 50 words that have fewer bytes are told beside them."""
    rng = random.Random(23)
    short, long = words(rng, 51, 9), words(rng, 80, 10**12)
    assert len(short) < 400 < len(long)
    texts = [f"{words(rng, 20)} {short} {words(rng, 20)}", f"{words(rng, 9)}\n{short} {words(rng, 30)}", f"{words(rng, 8)} {long}", f"{long} {words(rng, 7)}"]
    texts += [words(rng, 60), words(rng, 300), None, "", *[words(rng, 70)] * 3]
    monkeypatch.setattr(queries, "table", lambda *_: spark.createDataFrame(list(enumerate(texts)), DOCS))
    got = {r["doc_id"]: r for r in queries.op2_suffix_dedup(spark, "").collect()}
    assert [tuple(got[i])[1:5] for i in range(len(texts))] == brute_cut([(t or "").encode() for t in texts])
    assert [got[i]["n_removed"] for i in (0, 1)] == [0, 0]
    assert [got[i]["n_passage_bytes"] for i in range(len(texts))] == [len(short)] * 2 + [len(long)] * 2 + [0] * 4 + [len(texts[-1])] * 3


def test_suffix_dedup_with_passages_beside_on_a_table(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    kept = dict(zip(texts, brute_passages(list(texts.values()))))
    for r in queries.op2_suffix_dedup(spark, sf).collect():
        words_gone = len(texts[r["doc_id"]].split()) - len(kept[r["doc_id"]])
        assert (r["n_passage_bytes"] > 0) == (words_gone > 0) and r["n_passage_bytes"] >= 2 * words_gone - 1


def test_equal_sequences_stand_once_in_the_construction(tmp_path):
    rng = np.random.default_rng(5)
    some = [rng.integers(1, 3, n) for n in rng.integers(1, 12, 40)]
    copies = rng.integers(1, 4, len(some))
    once, every = bwt.padded(some), bwt.padded([x for x, n in zip(some, copies) for _ in range(n)])
    of = np.repeat(np.arange(len(some)), copies)
    for length in (1, 4, 9):
        seq, start = bwt.repeated(*every, length, tmp_path)
        mine = bwt.repeated(*once, length, tmp_path, copies)
        assert set(zip(of[seq].tolist(), start.tolist())) == set(zip(mine[0].tolist(), mine[1].tolist()))


def test_substring_dedup_stage(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    got = sorted((r["doc_id"], (r["text"] or "").split()) for r in corpus_pipeline.substring_dedup(spark, docs, "").collect())
    assert got == sorted(zip([r["doc_id"] for r in rows], brute_passages([r["text"] for r in rows])))


def test_bwt():
    rng = random.Random(1)
    for _ in range(30):
        seqs = [np.array([rng.randint(1, 3) for _ in range(rng.randint(0, 12))], np.uint16) for _ in range(rng.randint(1, 6))]
        with tempfile.TemporaryDirectory() as d:
            _, lcp, s, o = bwt.build(*bwt.padded(seqs), Path(d))
        got = [list(seqs[a][p:]) for a, p in zip(s, o)]
        assert got == sorted(list(q[i:]) for q in seqs for i in range(len(q) + 1))
        for i in range(1, len(got)):
            assert lcp[i] == len(list(itertools.takewhile(lambda x: x[0] == x[1], zip(got[i], got[i - 1]))))


# ---- SimHash


def test_fingerprint():
    def plain(text):
        w = text.encode().lower().split()
        hs = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
        return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hs) > len(hs))

    for t in ("", "a", "A b\tc", "a b c d", "a b c d E É f g\x0bh", words(random.Random(2), 200)):
        assert simhash.fingerprint(t) == plain(t)
    assert simhash.fingerprint(None) == 0


@pytest.mark.parametrize(("tile", "blocks"), [(4096, 7), (7, 7), (4096, 9)])
def test_components(spark, tile, blocks):
    rng = random.Random(8)
    values = {rng.getrandbits(64) for _ in range(60)}
    for v in list(values)[:8]:
        for _ in range(12):
            for b in rng.sample(range(64), rng.randint(1, 3)):
                v ^= 1 << b
            values.add(v)
    values = sorted(values)
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in itertools.combinations(values, 2):
        if (a ^ b).bit_count() <= 4:
            root[find(a)] = find(b)
    want = {frozenset(v for v in values if find(v) == r) for r in {find(v) for v in values}}
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    df = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.near_links(df, 4, tile, blocks)).collect()}
    groups = {}
    for v in values:
        groups.setdefault(roots.get(signed(v), signed(v)), set()).add(v)
    assert {frozenset(g) for g in groups.values()} == want


def stages_of(spark, work):
    """Stages that Spark runs for work, and its result."""
    context = spark.sparkContext
    context.setJobGroup("counted", "")
    try:
        out = work()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    ran = {i for j in tracker.getJobIdsForGroup("counted") for i in tracker.getJobInfo(j).stageIds}
    return sum(bool((info := tracker.getStageInfo(i)) and info.numCompletedTasks) for i in ran), out


def test_components_of_few_links(spark):
    """A few links need no rounds of shuffles, and give what the rounds give."""
    rng = random.Random(18)
    links = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 300), rng.randrange(100, 300)) for _ in range(120)] + [(500, 500), (-7, 600), (600, -7)]
    df = spark.createDataFrame(links, "a long, b long")
    few, found = stages_of(spark, lambda: {(r["node"], r["root"]) for r in simhash.components(df).collect()})
    many, by_rounds = stages_of(spark, lambda: {(r["node"], r["root"]) for r in simhash.components(df, few=3).collect()})
    assert found == by_rounds and (600, -7) in found and (40, 0) in found and all(n > r for n, r in found)
    assert few <= 8 < many
    assert simhash.components(df.limit(0)).count() == 0


def test_near_groups_edges(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a b c d e"), (3, "a b c d e"), (None, "z")], DOCS)
    got = sorted(map(str, [tuple(r) for r in simhash.near_groups(df).select("doc_id", "component_id").collect()]))
    assert got == sorted(["(1, 1)", "(2, 1)", "(3, 3)", "(3, 3)", "(None, None)"])
    assert simhash.near_groups(df.limit(0)).count() == 0


# ---- near copies


def brute_groups(texts, words=5, similarity=0.8):
    """Per text the least place that links of that Jaccard similarity reach."""
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))})
    holders, root = {}, list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        both = {}
        for x in s:
            for j in holders.setdefault(x, []):
                both[j] = both.get(j, 0) + 1
            holders[x].append(i)
        for j, n in both.items():
            if n >= similarity * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("tile", [1024, 5])
def test_near_copies(spark, tile):
    rng = random.Random(12)
    texts = [None, "", "a b c", "A  b c", "a b d"]
    for _ in range(12):
        base = words(rng, 150).split()
        texts.append(" ".join(base))
        for k in range(7):  # k words changed: similarity from 1 to 0.65
            t = list(base)
            for i in rng.sample(range(150), k):
                t[i] = "changed"
            texts.append(" ".join(t))
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_groups(df, tile=tile).collect()}
    assert [got[i] for i in range(len(texts))] == brute_groups(texts)
    assert neardup.near_groups(df.limit(0)).count() == 0


def test_near_copies_by_fingerprint(spark):
    """All that op9's fingerprints link is proposed, also where no band agrees; copies by another fingerprint too."""
    rng = random.Random(21)
    texts = []
    for _ in range(6):
        base = words(rng, 400).split()
        texts += [" ".join(base), " ".join(base[:-1] + ["changed"]), " ".join(["other", *base[1:]]), " ".join(base).upper()]
    fps = [simhash.fingerprint(t) for t in texts]
    near = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if (fps[i] ^ fps[j]).bit_count() <= 4]
    assert len(near) > 12
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).selectExpr("doc_id", "doc_id row_key", "text t")
    rows = docs.mapInArrow(neardup._keys, neardup.ROWS).withColumn("keys", F.array("doc_id"))  # no bands
    same = {r["doc_id"]: r["same"] for r in rows.collect()}
    roots = {r["node"]: r["root"] for r in neardup.proposed(rows, rows).collect()}
    root = [roots.get(same[i], same[i]) for i in range(len(texts))]
    assert all(root[i] == root[j] for i, j in near) and len(set(root)) >= 6


def test_near_dedup_stage(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id")
    rows = docs.select("doc_id", "text").collect()
    want = {rows[i]["doc_id"] for i in brute_groups([r["text"] for r in rows])}
    kept = [r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").select("doc_id").collect()]
    assert sorted(kept) == sorted(want)


# ---- Order MinHash


def brute_signature(text):
    """Order MinHash with cells, k-mer by k-mer."""

    def chain(parts):
        h = 42
        for x in parts:
            h = xxhash.xxh64_intdigest(x.encode(), h)
        return h

    tokens = re.findall(r"[^ \t\n\x0b\f\r]{1,8}", text or "")
    mask = (1 << ordermin.HASH_BITS) - 1
    seen, found = collections.Counter(), []
    for i in range(max(0, len(tokens) - ordermin.K) + 1):
        mer = chain(tokens[i : i + ordermin.K]) & mask
        seen[mer] += 1
        # the k-mer's hash is a long, its number an int
        h = xxhash.xxh64_intdigest(seen[mer].to_bytes(4, "little"), xxhash.xxh64_intdigest(mer.to_bytes(8, "little"), 42)) & mask
        found.append((h, i))
    found.sort()

    def tuple_of(kept):
        total = 42
        for h, _ in sorted(kept, key=lambda x: x[1]):
            total = xxhash.xxh64_intdigest(h.to_bytes(8, "little"), total)
        return total & 0xFFFFFFFF

    cells = [[x for x in found if x[0] >> (ordermin.HASH_BITS - ordermin.CELL_BITS) == j][: ordermin.LENGTH] for j in range(ordermin.TUPLES)]
    own = [tuple_of(c) if len(c) == ordermin.LENGTH else None for c in cells]
    out = []
    for j in range(ordermin.TUPLES):
        step = (5 * j) % (ordermin.TUPLES // 2) * 2 + 1
        tried = [own[(j + i * step) % ordermin.TUPLES] for i in range(ordermin.TUPLES)]
        out.append(next((x for x in tried if x is not None), tuple_of(found[: ordermin.LENGTH])))
    return out


def test_order_minhash(spark):
    rng = random.Random(9)
    long = words(rng, 400)
    texts = [long, long, " ".join(reversed(long.split())), None, "", "a", "b b b b b b b b", "é" * 50, long + " tail"]
    texts += [words(rng, n, 40) for n in (2, 3, 4, 5, 9, 30, 60, 100, 200, 700)] + ["x " * 300, long * 3]
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    rows = {r["doc_id"]: r for r in ordermin.fingerprint_pairs(df).collect()}
    assert len(rows) == len(texts)
    own = [brute_signature(t) for t in texts]
    for i, t in enumerate(texts):
        assert rows[i]["fingerprint"] == "".join(f"{x:08x}" for x in own[i])
        assert rows[i]["near_next"] == sum(x == y for x, y in zip(own[i], own[(i + 1) % len(texts)])) / ordermin.TUPLES
    for i, t in enumerate(texts):
        t, nxt = t or "", texts[(i + 1) % len(texts)] or ""
        h = len(t) // 2
        assert rows[i]["n_chars"] == len(t)
        assert rows[i]["edited_sha256"] == hashlib.sha256((t[: len(t) - h] + nxt[:h]).encode()).hexdigest()
        assert (rows[i]["near_next"] == 1.0) == (rows[i]["fingerprint"] == rows[(i + 1) % len(texts)]["fingerprint"])
    assert rows[0]["fingerprint"] == rows[1]["fingerprint"] and rows[3]["fingerprint"] == rows[4]["fingerprint"]
    assert rows[1]["near_next"] < 0.2 and sum(x == y for x, y in zip(own[0], own[8])) > 0.8 * ordermin.TUPLES
    assert ordermin.fingerprint_pairs(df.limit(0)).count() == 0


def test_order_minhash_blocks(spark, monkeypatch):
    monkeypatch.setattr(ordermin, "BLOCK_ROWS", 3)
    rng = random.Random(10)
    ids = rng.sample(range(10**6), 40)
    texts = {i: words(rng, 5) for i in ids}
    rows = {r["doc_id"]: r for r in ordermin.fingerprint_pairs(spark.createDataFrame(list(texts.items()), DOCS)).collect()}
    order = sorted(ids)
    for i, d in enumerate(order):
        t, nxt = texts[d], texts[order[(i + 1) % len(order)]]
        h = len(t) // 2
        assert rows[d]["edited_sha256"] == hashlib.sha256((t[: len(t) - h] + nxt[:h]).encode()).hexdigest()
    # ids far off, negative, repeated and absent leave blocks of like size
    odd = [(2**50, "far"), (-5, "low"), (None, "n1"), (None, "n2"), (None, None)] + [(7, words(rng, 4)) for _ in range(20)]
    df = spark.createDataFrame(odd + list(texts.items()), DOCS)
    sizes = [r["count"] for r in ordermin.in_blocks(df, "doc_id", "text").filter("ghost = 0").groupBy("block").count().collect()]
    assert max(sizes) <= 3 and sum(sizes) == 65
    got = ordermin.fingerprint_pairs(df).collect()
    assert len(got) == 65 and all(r["near_next"] == 0 for r in got if r["doc_id"] is None)
    far = next(r for r in got if r["doc_id"] == 2**50)
    assert far["edited_sha256"] == hashlib.sha256(b"fal").hexdigest()


# ---- packing and mixing


def test_boundaries():
    rng = random.Random(3)
    for _ in range(40):
        counts = np.array([rng.choice([0, 0, 1, 5]) for _ in range(9)])
        used = np.flatnonzero(counts)
        if not len(used):
            assert packing.boundaries(counts, 2) == []
            continue
        k = rng.randint(1, 4)
        cost = lambda edges: sum(counts[n] * min(e for e in edges if e >= n) for n in used)
        best = min(cost((*c, used[-1])) for j in range(k) for c in itertools.combinations(used[:-1], min(j, len(used) - 1)))
        assert cost(packing.boundaries(counts, k)) == best


def test_pack(spark):
    rng = random.Random(6)
    rows = [(i % 50, words(rng, rng.randrange(90))) for i in range(200)] + [(None, None), (7, ""), (7, " \t"), (8, "  a\u00a0b \n" * 90), (8, " ".join("xyz" * 90) + "\n"), (9, "q " * 5000)]
    rows += rows[:20]
    df = spark.createDataFrame(rows, DOCS).withColumn("bucket", F.lit("clash")).withColumn("part", F.lit(1))
    got = packing.pack(df, max_len=32, buckets=4, batch_tokens=128).collect()
    assert sum(r["n_tokens"] for r in got) == sum(len(re.findall(r"[^ \t\n\x0b\f\r]+", t or "")) for _, t in rows)
    assert all(r["n_tokens"] == len(re.findall(r"[^ \t\n\x0b\f\r]+", r["text"])) for r in got)
    texts = {}
    for r in sorted(got, key=lambda r: r["piece"]):
        key = (r["doc_id"], r["text_key"], r["copy"])
        texts.setdefault(key, []).append(r["text"])
    assert collections.Counter((k[0], "".join(v)) for k, v in texts.items()) == collections.Counter((i, t or "") for i, t in rows)
    places = {(r["bucket"], r["batch_id"], r["slot"]) for r in got}
    assert len(places) == len(got) and all(r["n_tokens"] <= r["bucket"] for r in got)
    for b in {r["bucket"] for r in got}:
        n, per = sum(r["bucket"] == b for r in got), max(1, 128 // max(b, 1))
        assert {(r["batch_id"], r["slot"]) for r in got if r["bucket"] == b} == {(i // per, i % per) for i in range(n)}
    assert packing.pack(df.limit(0)).count() == 0


def test_mix(spark):
    rng = random.Random(5)
    rows = [(i, words(rng, 10), s) for i, s in enumerate(["a"] * 300 + ["b"] * 60 + ["c"] * 30 + [None] * 10)] + [(400, None, "empty")]
    df = spark.createDataFrame(rows, DOCS + ", source string").withColumns({c: F.lit("clash") for c in ("__src", "weight", "tokens", "__start", "a.b")})
    mixed = mixing.mix(df, min_entropy=0.95)
    assert mixed.columns[: len(df.columns)] == df.columns and mixed.filter("__src = 'clash' and weight = 'clash' and `a.b` = 'clash'").count() == len(rows)
    got = mixed.collect()
    assert len(got) == len(rows)
    w = {r["source"]: r["__weight"] for r in got if r["source"] != "empty"}
    h = -sum(x * np.log(x) for x in w.values()) / np.log(4)
    assert abs(h - 0.95) < 1e-6 and abs(sum(w.values()) - 1) < 1e-9
    for s, x in w.items():
        taken = sum(r["__repeats"] * r["__tokens"] for r in got if r["source"] == s)
        assert abs(taken - x * 4000) <= 10
    for s in w:  # places: a permutation of the source's rows, and what is taken is its beginning
        own = sorted((r["__place"], r["__tokens"], r["__repeats"]) for r in got if r["source"] == s)
        assert [x[0] for x in own] == list(itertools.accumulate((x[1] for x in own), initial=0))[:-1]
        assert [x[2] for x in own] == sorted((x[2] for x in own), reverse=True)
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["__place"]) if r["source"] == "a"] != list(range(300))
    turns = sorted(mixing.turns(mixed).collect(), key=lambda r: r["__turn"])
    assert len(turns) == sum(r["__repeats"] for r in got) and 0 <= turns[0]["__turn"] and turns[-1]["__turn"] < 1
    for part in (0.3, 0.6):  # any beginning of the mixture holds the sources by their weights
        seen = collections.Counter()
        for r in turns[: int(len(turns) * part)]:
            seen[r["source"]] += r["__tokens"]
        assert all(abs(seen[s] / sum(seen.values()) - x) < 0.03 for s, x in w.items())
    kept = mixing.mix(df, max_repeats=2.0, budget_ratio=None, places=False).collect()
    assert min(r["__repeats"] for r in kept) >= 1 and max(r["__repeats"] for r in kept) == 2
    assert mixing.mix(df.limit(0), min_entropy=0.9).count() == 0
    odd = spark.createDataFrame([(1, "a b", None), (2, "c", "\x00"), (3, "d e f", "-"), (4, "g", "+")], DOCS + ", source string")
    assert sorted(r["__all"] for r in mixing.mix(odd, min_entropy=0.5).collect()) == [1, 1, 2, 3]


@pytest.mark.parametrize(("entropy", "repeats", "ratio"), [(0.9, None, 1.0), (1.0, None, 1.0), (None, 3.0, 1.0), (None, 2.0, None), (None, None, 1.0)])
def test_exponent(spark, entropy, repeats, ratio):
    tokens = [500.0, 120.0, 60.0, 5.0]
    p = np.array(tokens) / sum(tokens)

    def fits(a):
        w = p**a / (p**a).sum()
        if entropy is not None:
            return -(w * np.log(w)).sum() >= entropy * np.log(4) - 1e-12
        return repeats is None or (w / p).max() * ratio <= repeats if ratio else (w / p).max() / (w / p).min() <= repeats

    found = mixing.weights(spark.createDataFrame([(str(i), int(t)) for i, t in enumerate(tokens)], "src string, tokens long"), entropy, repeats, ratio).orderBy("src").collect()
    alpha = found[0]["alpha"]
    grid = np.linspace(0, 1, 20_001)
    good = grid[[bool(fits(a)) for a in grid]]
    assert abs(alpha - (good.min() if repeats else good.max())) < 1e-4
    assert np.allclose([r["weight"] for r in found], p**alpha / (p**alpha).sum())


# ---- urls


def test_urls(spark):
    urls = [None, "", "nothing", "HTTP://WWW.Example.COM/en/71?x#y", "http://a.com/en/", "http://com/en/q", "http://xcom/en/", "https://b.net/de/8", "https://s.example.net/de/81#t", "ftp://q.org", "x://h?y://z"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    good = spark.createDataFrame([(9, 1), (3, 0), (3, None)], "page_id long, good int")
    rules = spark.createDataFrame(queries.RULES, "host string, path string, action string")
    got = {r["page_id"]: r for r in urlrep.judge(pages, good, rules).collect()}
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"]) for i in range(len(urls))] == [
        ("", "", None), ("", "", None), ("", "", None), ("www.example.com", "/en/71", "example.com/en/7"), ("a.com", "/en/", "com/en/"), ("com", "/en/q", "com/en/"),
        ("xcom", "/en/", None), ("b.net", "/de/8", "net/de/"), ("s.example.net", "/de/81", "example.net/de/8"), ("q.org", "", None), ("h", "", None),
    ]
    assert [got[i]["verdict"] for i in (3, 4, 5, 7, 8)] == ["allow", "block", "block", "allow", "block"]
    bad = spark.createDataFrame([(i, f"http://bad.example.org/{i}") for i in range(100, 200)] + [(i, f"http://fine.example.org/{i}") for i in range(200, 300)], "page_id long, url string")
    marks = spark.createDataFrame([(i, int(i >= 200)) for i in range(100, 300)], "page_id long, good int")
    by = {(r["host"], r["verdict"]) for r in urlrep.judge(bad, marks, rules).collect()}
    assert by == {("bad.example.org", "block"), ("fine.example.org", "allow")}
    assert urlrep.judge(pages.limit(0), good.limit(0), rules).count() == 0


# ---- models


def test_language_id(spark):
    rng = random.Random(2)
    make = lambda alphabet: " ".join("".join(rng.choice(alphabet) for _ in range(5)) for _ in range(30))
    rows = [(i, make("abcde" if i % 2 else "vwxyz"), "aa" if i % 2 else "zz") for i in range(200)]
    df = spark.createDataFrame(rows, DOCS + ", lang string")
    model = langid.train(df)
    sums = np.exp2(model.log2_rows(langid.code_points("   abcde edcba ")))
    assert (sums > 0).all() and (sums <= 1).all()
    more = spark.createDataFrame([(1, "abc dce"), (2, "zyx vw"), (3, None), (4, "12 .!"), (5, "ййй ффф ццц ы" * 20), (6, "abc" * 200_000)], DOCS)
    got = {r["doc_id"]: r for r in langid.identify(more, model).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 4, 6)] == ["aa", "zz", "und", "und", "aa"]
    assert got[3]["rejected"] and got[5]["rejected"] and not got[1]["rejected"] and got[3]["score"] == 0
    assert langid.identify(more.limit(0), model).count() == 0
    assert {r["lang_pred"] for r in langid.identify(more, langid.train(df.limit(0))).collect()} == {"und"}


def test_language_id_copies(spark):
    rng = random.Random(15)
    make = lambda alphabet: " ".join("".join(rng.choice(alphabet) for _ in range(5)) for _ in range(30))
    single = [(make("abcde"), "aa") for _ in range(150)] + [(make("vwxyz"), "zz") for _ in range(150)]
    df = spark.createDataFrame(single, "text string, lang string")
    # the copies' hash is the least of all, and they are more than the sample may hold
    first = df.filter("lang = 'aa'").orderBy(F.xxhash64("text")).limit(1)
    many = df.union(first.crossJoin(spark.range(3000)).select("text", "lang"))
    alone, among = langid.train(df, docs_per_lang=200), langid.train(many, docs_per_lang=200)
    assert among.langs == alone.langs == ["aa", "zz"]
    for a, b in zip(alone.grams, among.grams):
        assert (a[0] == b[0]).all() and (a[1] == b[1]).all()
    assert (alone.limits == among.limits).all()


def test_letters():
    assert langid.letters("Ab1c_d, \u0939\u093f\u0928\u094d\u0926\u0940!") == " ab c d \u0939\u093f\u0928\u094d\u0926\u0940 "
    assert langid.letters("12 .!") == langid.letters("\u0301 \u094d") == langid.letters(None) == ""


def test_kneser_ney_by_hand():
    """Probabilities by the textbook recursion over counted strings."""
    texts, order = [" abra cad abra ", " bad cab a ", " dab "], 4
    padded = [" " * (order - 1) + t for t in texts]
    joined = "".join(padded)
    top = collections.Counter(joined[max(0, i - order + 1) : i + 1].rjust(order, "\x00") for i in range(len(joined)))
    counts = {order: top}
    for n in reversed(range(1, order)):  # numbers of distinct left extensions
        counts[n] = collections.Counter(g[1:] for g in counts[n + 1])

    def p(n, gram):
        if n == 0:
            return langid.UNIFORM
        c = counts[n]
        one, two = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        d = min(0.95, max(0.05, one / (one + 2 * two) if one else 0.5))
        near = {g: v for g, v in c.items() if g[:-1] == gram[:-1]}
        lower = p(n - 1, gram[1:])
        if not near:
            return lower
        total = sum(near.values())
        return max(near.get(gram, 0) - d, 0) / total + d * len(near) / total * lower

    model = langid.Model({"xx": texts}, order)
    asked = "   abba dcab za"
    got = model.log2_rows(langid.code_points(asked))[:, 0]
    for i in range(order - 1, len(asked)):
        assert abs(got[i] - np.log2(p(order, asked[i - order + 1 : i + 1]))) < 1e-4, asked[: i + 1]


def test_held_out_language(spark):
    """Languages of the fold that nothing was learned from; texts in two languages are labelled by one of them."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    got = queries.op5_language_id(spark, sf).filter("held_out and lang_pred <> 'und'").join(docs, "doc_id").filter("lang is not null")
    right, n = got.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert n > 100 and right >= 0.97 * n


def test_held_out_toxicity(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    got = queries.op6_toxicity(spark, sf).filter("held_out").join(labels, "doc_id").groupBy("toxic").agg(F.count("*").alias("n"), F.sum("predicted").alias("k"))
    by = {r["toxic"]: (r["k"], r["n"]) for r in got.collect()}
    assert by[0][0] <= 0.05 * by[0][1] and (1 not in by or by[1][0] >= 0.8 * by[1][1])


def test_kneser_ney_sums_to_one():
    m = langid.KneserNey([" ab ba ab abba "] * 3, 3)
    for n in range(3):
        keys, p, ctx, gamma, suffix, context = m.levels[n]
        lower = {int(k): x for k, x in zip(m.levels[n - 1][0], m.levels[n - 1][1])} if n else {}
        for c, g in zip(ctx, gamma):
            of = context == c
            rest = 1 - sum(lower[int(s)] for s in suffix[of]) if n else 1 - of.sum() * langid.UNIFORM
            assert abs(p[of].sum() + g * rest - 1) < 1e-9


def test_toxicity(spark):
    rng = random.Random(7)
    rows = [(i, words(rng, 40) + (" vile scum" if i % 10 == 0 else "")) for i in range(600)]
    labels = [(i, int(i % 10 == 0)) for i in range(0, 600, 3)] + [(1, None)]
    df, lab = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(df, lab)
    more = spark.createDataFrame([(1, "so vile a scum"), (2, "w1 w2 w3"), (3, None), (4, "")], DOCS)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(more, model).collect()}
    assert got[1] > 0.6 and got[2] < 0.3 and got[3] == got[4] < 0.3
    nothing = toxicity.train(df, lab.filter("toxic = 0"))
    assert max(r["score"] for r in toxicity.score(more, nothing).collect()) < 1e-9
    assert toxicity.score(more.limit(0), model).count() == 0


def test_toxicity_copies(spark):
    rng = random.Random(16)
    rows = [(i, words(rng, 40) + (" vile scum" if i % 10 == 0 else "")) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(0, 600, 3)], "doc_id long, toxic int")
    df = spark.createDataFrame(rows, DOCS)
    # copies of the text that the draw of unlabelled ones takes first, more than both samples may hold
    top = df.filter("doc_id % 3 = 1").orderBy(F.pmod(F.xxhash64("text"), F.lit(1_000_000)).desc()).limit(1)
    many = df.union(top.crossJoin(spark.range(1000, 4000)).select("id", "text"))
    bounds = {"max_positive": 60, "max_unlabelled": 300}
    alone, among = toxicity.train(df, labels, **bounds), toxicity.train(many, labels, **bounds)
    assert len(alone.slots) and (alone.slots == among.slots).all() and (alone.weights == among.weights).all() and alone.bias == among.bias
    assert among.score(["so vile a scum"])[0] > 0.6 > 0.3 > among.score(["w1 w2 w3"])[0]


# ---- neighbours


def test_nearest(spark):
    rng = np.random.default_rng(1)
    v = rng.standard_normal((600, 24)).astype(np.float32)
    v[100:200] = v[100]
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(900, None), (901, [0.0] * 24), (902, [float("nan")] * 24), (903, [None] * 24), (904, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in ann.nearest(df, df.filter("vec_id % 20 = 0"), k=10, block_rows=150).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    d = v.astype(float)
    hits = 0
    for q in range(0, 600, 20):
        s = (d * d[q]).sum(axis=1)
        want = [i for i in np.lexsort((np.arange(600), -s)) if i != q][:10]
        hits += len({x[0] for x in got[q].values()} & set(want))
        assert all(abs(s[i] - x) < 1e-12 for i, x in got[q].values())
    assert hits >= 0.97 * 300 and set(got) == set(range(0, 600, 20))
    assert [got[100][r][0] for r in range(1, 11)] == list(range(101, 111))
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


# ---- chat


def best_cost(roles):
    """Least cost over all edit sequences, by Dijkstra over (turns done, state)."""
    import heapq

    seen, heap = set(), [(0.0, 0, 0)]
    while heap:
        c, i, s = heapq.heappop(heap)
        if (i, s) in seen:
            continue
        seen.add((i, s))
        if i == len(roles) and s == chat.FINAL:
            return c
        for to in chat.NEXT[s]:
            heapq.heappush(heap, (c + chat.INSERT, i, to))
            if i < len(roles):
                heapq.heappush(heap, (c + (chat.KEEP if roles[i] == to - 1 else chat.RELABEL), i + 1, to))
        if i < len(roles) and s:
            heapq.heappush(heap, (c + chat.MERGE + (chat.KEEP if roles[i] == s - 1 else chat.RELABEL), i + 1, s))
    return None


@pytest.mark.parametrize("one", [False, True])
def test_chat(spark, one):
    rng = random.Random(11)
    convs = {c: [rng.choice([*chat.ROLES, "user", "assistant", "bot", None]) for _ in range(rng.randint(1, 11) if not one else 400)] for c in range(1 if one else 30)}
    texts = ["t", "x <|user|> <\\|end|> y", "", None]
    rows = [(c, i, r, f"t{i}" if i % 5 else texts[i % 4]) for c, roles in convs.items() for i, r in enumerate(roles)] + [(None, None, "user", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"part": F.lit("clash"), "n": F.lit(1)})
    got = chat.repair(df).collect()
    assert len(got) == len(rows)
    spread = {r["p"] for r in chat.in_ranges(df, "conv_id", "turn", "role", "text").filter("conv_id = 0").select(F.spark_partition_id().alias("p")).collect()}
    assert not one or len(spread) > 1  # one conversation is dealt to several ranges
    for c, roles in convs.items():
        mine = sorted((r for r in got if r["conv_id"] == c), key=lambda r: r["seq"])
        assert [r["seq"] for r in mine] == list(range(len(roles))) and [r["turn"] for r in mine] == list(range(len(roles)))
        assert sum(r["cost"] for r in mine) == best_cost([chat.role_of(r) for r in roles])
        text = "".join(r["rendered"] for r in mine)
        written = [p.split("|>")[0] for p in text.split("<|")[1:] if not p.startswith("end|>")]
        state = 0
        for w in written:
            assert chat.ROLES.index(w) + 1 in chat.NEXT[state]
            state = chat.ROLES.index(w) + 1
        assert state == chat.FINAL and text.count("<|end|>") == len(written) and all(f"t{i}" in text for i in range(len(roles)) if i % 5)
    assert chat.repair(df.limit(0)).count() == 0


def test_chat_without_turns(spark):
    """A conversation of null and repeated turns is ordered by role and text, and may span ranges."""
    rng = random.Random(3)
    rows = [("c", None if i % 3 else 7, rng.choice(["user", "assistant"]), f"m{rng.randrange(500)}") for i in range(900)]
    got = sorted(chat.repair(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")).collect(), key=lambda r: r["seq"])
    assert [r["seq"] for r in got] == list(range(900))
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    assert [(r["turn"], r["role_in"]) for r in got] == [(r[1], r[2]) for r in order]
    assert all(r[3] in g["rendered"] for r, g in zip(order, got)) and sum(r["cost"] for r in got) == best_cost([chat.role_of(r[2]) for r in order])


# ---- pipeline


def test_pipeline_edges(spark):
    """Nulls anywhere, empty and very long texts, repeated rows, extra and clashing columns, empty tables."""
    rng = random.Random(21)
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    plain = [(i, words(rng, 60), "en", "web", 9) for i in range(40)]
    rows = plain + plain[:3] + [(None, words(rng, 30), None, None, None), (50, None, "en", "web", 0), (51, "", "en", None, 0), (52, " \n", None, "web", 2), (50, None, "de", "books", None)]
    rows += [(60, words(rng, 120_000), "en", "web", 9), (61, plain[0][1], "en", "other", 9), (61, plain[0][1], "en", "another", 9)]
    docs = spark.createDataFrame(rows, kind).withColumns({c: F.lit("clash") for c in ("row_key", "__cut", "__rid", "__copy", "h", "bucket", "__tokens", "part")})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        n, empty = out.count(), stage(spark, docs.limit(0), "")
        assert empty.count() == 0 and empty.columns == out.columns, name
        if name != "packing":
            assert out.columns == corpus_pipeline.COLUMNS, name
        have = collections.Counter(tuple(r) for r in out.collect())
        if name == "near_dedup":
            ids = sorted(r[0] if r[0] is not None else -1 for r in have.elements())
            assert ids == [-1, *range(40), 50, 60]
            again = collections.Counter(tuple(r) for r in stage(spark, docs.orderBy(F.rand(3)), "").collect())
            assert again == have
        elif name == "suffix_dedup":
            assert n == len(rows) and sum(r[1] is None for r in have.elements()) == 2
        elif name == "mixing":
            assert set((r[0], r[1], r[3]) for r in have) == set((r[0], r[1], r[3]) for r in rows)
        elif name == "packing":
            texts = {}
            for r in sorted(out.collect(), key=lambda r: r["piece"]):
                texts.setdefault((r["doc_id"], r["text_key"], r["copy"]), []).append(r["text"])
            assert collections.Counter((k[0], "".join(v)) for k, v in texts.items()) == collections.Counter((r[0], r[1] or "") for r in rows)


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == columns and docs.count() > 0, name
    out = corpus_pipeline.run(spark, sf)
    assert out.agg(F.sum("n_tokens")).first()[0] == docs.agg(F.sum(packing.word_count(F.col("text")))).first()[0]


def test_numbers_are_no_letters(spark):
    texts = ["\u00bd \u00b2 \u2462", "\u2167", "\u2167 abc", "\u4e00\u4e8c", "1\u0660"]
    assert [langid.letters(t) for t in texts] == ["", "", " abc ", " \u4e00\u4e8c ", ""]
    df = spark.createDataFrame([(i, t, "xx", 7.0, "kept") for i, t in enumerate(texts)], "doc_id long, text string, lang string, score double, rejected string")
    model = langid.train(spark.createDataFrame([("abc abd bcd", "xx")] * 3, "text string, lang string"))
    found = langid.identify(df, model, keep=("score", "rejected", "lang"))
    assert found.columns == ["doc_id", "lang", "lang_pred", "score", "cross_entropy", "rejected"]
    assert {r["doc_id"]: (r["lang_pred"], r["score"] > 0) for r in found.collect()} == {0: ("und", False), 1: ("und", False), 2: ("xx", True), 3: ("xx", True), 4: ("und", False)}
    with pytest.raises(ValueError, match="languages"):
        langid.train(spark.createDataFrame([("abc", "xx"), ("abc", "yy")], "text string, lang string"), max_langs=1)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_nearest_at_all_magnitudes(spark, kind):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((600, 24))
    for scale in [1e-30, 1.0, 1e37, "mixed"] if kind == "float" else [1e-100, 1e-30, 1.0, 1e100, "mixed"]:
        power = rng.integers(-12, 12, 600) if scale == "mixed" else np.zeros(600)
        v = base * (1.0 if scale == "mixed" else scale) * (10.0 ** power)[:, None]
        v = v.astype(np.float32 if kind == "float" else np.float64)
        df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], f"vec_id long, embedding array<{kind}>")
        got: dict = {}
        for r in ann.nearest(df, df.filter("vec_id % 20 = 0"), k=10, block_rows=150).collect():
            got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
        for q in range(0, 600, 20):
            score = ann.exact(v, v[q].astype(np.float64))
            want = sorted((i for i in range(600) if i != q), key=lambda i: (-score[i], i))[:10]
            assert [got[q][k + 1] for k in range(10)] == [(i, score[i]) for i in want], (scale, q)


def test_toxicity_risk():
    """Both branches of the slope against finite differences, the risk against plain loops."""
    rng = np.random.default_rng(4)
    seen = set()
    for prior in (0.05, 0.4, 0.9):
        for over in (False, True):  # a classifier that knows the positives by heart drives the second term below zero
            n, m, k = 7, 11, 6
            docs = [[rng.permutation(k)[: rng.integers(1, k)] for _ in range(n)], [rng.permutation(k)[: 0 if over else rng.integers(0, k)] for _ in range(m)]]
            theta = np.append(np.full(k, 6.0), -5.0) if over else rng.standard_normal(k + 1)
            args = (*toxicity.flat(docs[0]), *toxicity.flat(docs[1]), n, m, prior)

            def plain(theta):
                loss = lambda x: np.log1p(np.exp(-x))
                g = [[theta[-1] + sum(theta[j] for j in d) for d in side] for side in docs]
                return prior * sum(map(loss, g[0])) / n, sum(loss(-x) for x in g[1]) / m - prior * sum(loss(-x) for x in g[0]) / n

            positive, negative, slope = toxicity.risk(theta, *args)
            assert np.allclose((positive, negative), plain(theta))
            seen.add(negative >= 0)
            whole = (lambda t: sum(plain(t))) if negative >= 0 else (lambda t: -plain(t)[1])
            for j in range(k + 1):
                step = np.eye(k + 1)[j] * 1e-6
                assert abs((whole(theta + step) - whole(theta - step)) / 2e-6 - slope[j]) < 1e-6
    assert seen == {True, False}


def test_toxicity_scores(spark):
    """Scores of rows against a dictionary and a loop; features by their definition."""
    texts = ["Idiotic idiots, idiot!", "", None, "caf\u00e9 na\u00efve 12 caf\u00e9s", "x " * 5000, "Idiotic idiots, idiot!"]
    found = [set(re.findall(r"[^\W\d_]+", (t or "").lower())) for t in texts]
    slots = [{zlib.crc32(f.encode()) % toxicity.SLOTS for w in ws for f in [w, *(w[:n] + "-" for n in (4, 5, 6) if len(w) >= n)]} for ws in found]
    assert [set(toxicity.features(t).tolist()) for t in texts] == slots
    every = sorted(set().union(*slots))[::2]
    weights = {s: (i % 7 - 3) / 4 for i, s in enumerate(every)}
    model = toxicity.Classifier(np.array(every), np.array(list(weights.values())), -0.5)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame(list(enumerate(texts)), DOCS), model).collect()}
    assert all(abs(got[i] - 1 / (1 + np.exp(0.5 - sum(weights.get(s, 0) for s in have)))) < 1e-9 for i, have in enumerate(slots)) and got[0] == got[5]


# ---- Jaccard join, lexical ranking, periodic runs


def shingle_sets(docs, words=4):
    for i, t in docs:
        w = (t or "").encode().lower().split()
        yield i, frozenset(b" ".join(w[k : k + words]) for k in range(max(1, len(w) - words + 1))) if w else frozenset()


def brute_jaccard(docs, num=85, den=100):
    rows = list(shingle_sets(docs))
    sets = [s for s in dict.fromkeys(s for _, s in rows) if s]
    root = {s: s for s in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for k, s in enumerate(sets):
        both = collections.Counter(j for x in s for j in holders.get(x, ()))
        for j, n in both.items():
            if n * den >= num * (len(s) + len(sets[j]) - n):
                root[find(s)] = find(sets[j])
        for x in s:
            holders.setdefault(x, []).append(k)
    least = {}
    for i, s in rows:
        if s:
            least[find(s)] = min(least.get(find(s), i), i)
    return sorted((i, len(s), least[find(s)] if s else i) for i, s in rows)


def jaccard(df, **more):
    return sorted(tuple(r) for r in counttree.jaccard_groups(df, **more).select("doc_id", "n_shingles", "component_id").collect())


@pytest.mark.parametrize("leaf", [3, 1024])
def test_count_tree(spark, leaf):
    rng = random.Random(leaf)
    docs = []
    for _ in range(5):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.choice([3, 6, 7, 9, 12, 20, 40, 80]))]
        for _ in range(30):
            x = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
                x[rng.randrange(len(x))] = f"w{rng.randrange(500)}"
            docs.append((len(docs) * 7 % 151, (" " if rng.random() < 0.5 else "\t").join(x[: len(x) - (rng.random() < 0.3)])))
    docs += [(1000, None), (1001, ""), (1002, "  "), (1003, "A b"), (1004, "a B"), (1005, "a"), (1003, "A b")]
    df = spark.createDataFrame(docs, DOCS).withColumns({"n": F.lit(1), "same": F.lit("x"), "root": F.lit(2)})
    assert jaccard(df, leaf=leaf) == brute_jaccard(docs)
    assert jaccard(df.limit(0), leaf=leaf) == []
    assert [tuple(r) for r in counttree.jaccard_groups(spark.createDataFrame([(None, "a b")], DOCS)).select("doc_id", "component_id").collect()] == [(None, None)]


def test_count_tree_keys():
    """Two sets of the similarity share a key, whatever their sizes and wherever they differ; trees find all pairs that brute force finds."""
    rng = np.random.default_rng(5)
    for _ in range(4000):
        n = int(rng.integers(1, 90))
        a = np.unique(rng.integers(1, 1 << 63, n, dtype=np.uint64))
        apart = counttree.most_apart(len(a))
        out, more = int(rng.integers(0, apart + 1)), int(rng.integers(0, apart + 1))
        b = np.unique(np.append(rng.permutation(a)[out:], rng.integers(1, 1 << 63, more, dtype=np.uint64)))
        both = len(np.intersect1d(a, b))
        if both * 185 >= 85 * (len(a) + len(b)) and both < max(len(a), len(b)):
            assert len(np.intersect1d(counttree.keys_of(a), counttree.keys_of(b))), (len(a), len(b), both)
    for split in (None, 40):
        sets = []
        for _ in range(120):
            base = sets[int(rng.integers(len(sets)))] if sets and rng.random() < 0.7 else rng.integers(1, 1 << 63, int(rng.integers(1, 200)), dtype=np.uint64)
            sets.append(np.unique(np.append(base[rng.random(len(base)) > 0.04], rng.integers(1, 1 << 63, int(rng.integers(1, 4)), dtype=np.uint64))))
        points = counttree.points_of([counttree.point(s).tobytes() for s in sets])
        sizes = np.array([len(s) for s in sets])
        links = counttree.joined(sets, points, sizes, np.arange(120), split)

        def groups(pairs):
            label = list(range(120))
            for i, j in pairs:
                label = [label[i] if x == label[j] else x for x in label]
            return [label.index(x) for x in label]

        near = [(i, j) for i in range(120) for j in range(i) if len(np.intersect1d(sets[i], sets[j])) * 185 >= 85 * (len(sets[i]) + len(sets[j])) and (split is None or (j < split <= i))]
        assert set(links) <= {p for i, j in near for p in ((i, j), (j, i))} and groups(links) == groups(near) and near


def brute_ranked(docs, items, k=10):
    term = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    of = lambda t: term.findall((t or "").translate(low))
    found = [(i, of(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(t) for _, t in found), sum(len(t) for _, t in found)
    df = collections.Counter(x for _, t in found for x in set(t))
    out = []
    for item, text in items:
        ranked = []
        for i, t in found:
            tf = collections.Counter(t)
            m = 25 + (75 * len(t) * n_docs) // n_terms if n_terms else 0
            score = sum(balltree.weight(n_docs, df[x]) * ((10**9 * tf[x]) // (1000 * tf[x] + 8 * m)) for x in of(text) if tf[x])
            if score > 0:
                ranked.append((-score, (i is not None, i or 0), i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(ranked, key=lambda x: x[:2])[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize(("entries", "leaf", "queries"), [(6_000_000, 64, 1000), (400, 2, 3)])
def test_ball_tree(spark, entries, leaf, queries, monkeypatch):
    monkeypatch.setattr(balltree, "ENTRIES", entries)
    monkeypatch.setattr(balltree, "LEAF", leaf)
    monkeypatch.setattr(balltree, "QUERIES", queries)
    rng = random.Random(leaf)
    docs = [(rng.choice([i, i, i % 40]), words(rng, rng.choice([0, 1, 5, 30, 200]), 60)) for i in range(300)]
    docs += [(1, None), (2, ""), (None, "w1 w2 w3"), (3, "W1,w2;W\u00c9 w\u00e9 \u00c9 \x7f w3"), (3, "W1,w2;W\u00c9 w\u00e9 \u00c9 \x7f w3"), (4, "w7 " * 3000)]
    items = [(i, words(rng, rng.choice([1, 3, 20]), 70)) for i in range(9)] + [(20, None), (21, ""), (22, "nowhere"), (23, "w\u00e9 W\u00c9 w1"), (None, "w7 w7")]
    df, asked = spark.createDataFrame(docs, DOCS).withColumn("score", F.lit(1)), spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("x"))
    found = balltree.ranked(df, asked)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_ranked(docs, items)
    assert balltree.ranked(df.limit(0), asked).count() == balltree.ranked(df, asked.limit(0)).count() == 0


def test_ball_tree_bounds():
    """No leaf is left out that could hold one of the best, and most are left out where documents lie in clusters."""
    rng = np.random.default_rng(2)
    centers = (rng.random((40, 300)) < 0.05) * rng.integers(100, 900_000, (40, 300))
    x = np.concatenate([np.maximum(0, c[:, None] + (c > 0)[:, None] * rng.integers(-50, 50, (300, 50))) for c in centers], axis=1).astype(np.int32)
    tree = balltree.BallTree(x, leaf=16)
    asked = (rng.random((300, 30)) < 0.1) * rng.integers(1, 9000, (300, 30))
    bound, product = tree.bounds(asked.astype(np.float64)), tree.matrix.T.astype(np.int64) @ asked
    for node, (lo, hi) in enumerate(zip(tree.lo, tree.hi)):
        assert (bound[node] >= product[lo:hi].max(axis=0)).all()
    scored = 0
    for j in range(30):
        best: list = []
        at = np.flatnonzero(asked[:, j])
        scored += balltree.search(tree, np.arange(2000), bound[:, j], at, asked[at, j].astype(np.int64), best)
        assert sorted(best, reverse=True) == sorted(((int(s), -i) for i, s in enumerate(product[:, j])), reverse=True)[:10]
    assert scored < 30 * 2000 // 2


def brute_runs(w):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - start + q >= max(6, 4 * q) and i > start:
                found.setdefault((start, i - start + q), q)
            i += i == start
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_collapsed(w, runs):
    return " ".join(x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in runs))


def test_periodic_runs(spark):
    rng = random.Random(6)
    docs = []
    for i in range(400):
        w = [f"{rng.randrange(rng.choice([1, 2, 3, 9]))}" for _ in range(rng.choice([0, 1, 6, 7, 30, 90]))]
        if len(w) > 8 and rng.random() < 0.6:
            a = rng.randrange(len(w))
            p = 1 + (len(w) - a) // rng.randrange(3, 11)
            w = [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]
        docs.append((i % 390, rng.choice([" ", "\n\t", "  "]).join(w)))
    docs += [(500, None), (501, ""), (502, " \u00a0 "), (None, "a b " * 5), (503, "x " * 5000 + "y z " * 300)]
    df = spark.createDataFrame(docs, DOCS).withColumns({"runs": F.lit(1), "collapsed": F.lit(2), "t": F.lit(3)})
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.periodic_runs(df).collect()), key=str)
    split = lambda t: [x.decode() for x in (t or "").encode().split()]
    want = [(i, len(split(t)), brute_runs(split(t)) if i != 503 else [(0, 5000, 1), (5000, 600, 2)], t) for i, t in docs]
    assert got == sorted(((i, n, r, brute_collapsed(split(t), r)) for i, n, r, t in want), key=str)
    assert periodic.periodic_runs(df.limit(0)).count() == 0
    few = periodic.periodic_runs(spark.createDataFrame([(1, "a b a b")], DOCS), min_length=4, min_exponent=2).first()
    assert ([tuple(x) for x in few["runs"]], few["collapsed"]) == ([(0, 4, 2)], "a b")


@pytest.mark.parametrize("unit", [1 << 18, 50])
def test_periodic_query(spark, unit, monkeypatch):
    """The whole query against the stated rules on all of sf0.001, by brute force."""
    monkeypatch.setattr(periodic, "UNIT", unit)
    sf = "/root/testdata/sf0.001"
    rows = {r["doc_id"]: r for r in queries.op13_periodic_runs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for doc_id, text in docs:
        w = [x.decode() for x in (text or "").encode().split()]
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        if n > 1500 and h % 10:
            continue  # brute force takes the square
        runs, r = brute_runs(w), rows[doc_id]
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        assert r["n_runs"] == len(runs) and (r["start"], r["length"], r["period"]) == (best or (None, None, None))
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if best else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(brute_collapsed(w, runs).encode()).hexdigest()
