"""Queries of the training-data operators: each applies one to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, balltree, chat, counttree, langid, mixing, ordermin, packing, periodic, simhash, suffixdedup, toxicity, urlrep
from .common import held_out, table

RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]
TOXIC_FROM = 0.3
MIN_ENTROPY = 0.95


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(docs, min_entropy=MIN_ENTROPY, budget_ratio=1.0)
    turn = F.when(F.col("__budget") > 0, F.col("__place") / F.col("__budget"))
    return mixed.select(
        "doc_id", "source", F.col("__tokens").alias("n_tokens"), F.round("__weight", 6).alias("weight"), F.round("__alpha", 6).alias("alpha"), F.col("__repeats").alias("repeats"),
        F.col("__place").alias("place"), F.round(turn, 9).alias("first_turn"),
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = suffixdedup.dedup(docs, beside={"__passages": suffixdedup.PASSAGES})
    digest = F.sha2("__cut.kept", 256).alias("kept_sha256")
    return done.select("doc_id", "__cut.n_bytes", "__cut.n_removed", "__cut.n_spans", digest, F.col("__passages.n_removed").alias("n_passage_bytes"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return packed.select("doc_id", "copy", "piece", "n_tokens", "bucket", "padding", "batch_id", "slot", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


def op4_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    return urlrep.judge(pages, outcomes, rules).select("page_id", "host", "path", "rule", "verdict", "n_labelled", "posterior_mean")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.filter(~held_out(F.col("doc_id"))))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    seen = ~held_out(F.col("doc_id"))
    model = toxicity.train(docs.filter(seen), labels.filter(seen))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op7_rotated_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(rows, rows.filter(F.col("vec_id") % 20 == 0), k=20)


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordermin.fingerprint_pairs(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


def op11_count_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = counttree.jaccard_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups.select("doc_id", "n_shingles", "component_id")


def op12_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.ranked(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(periodic.planted(table(spark, sf_dir, "documents").select("doc_id", "text")))
    most = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("less"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    best = found.select("doc_id", "n_words", "runs", "collapsed", most.alias("m"), listed.alias("listed"))
    length, period = F.col("m.length"), -F.col("m.less")
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("m.before")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"), F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mixing, op2_suffix_dedup, op3_packing, op4_url_reputation, op5_language_id, op6_toxicity, op7_rotated_bits, op8_order_minhash, op9_simhash, op10_chat_repair,
        op11_count_tree, op12_ball_tree, op13_periodic_runs,
    )
}

_TAIL = "array_to_string(labels[-least({k}, len(labels)):], '.')"
_STRENGTH = """(SELECT CASE WHEN w > 0 AND s > e THEN least(1000.0, greatest(1.0, w / (s - e) - 1)) ELSE 1000.0 END FROM (
  SELECT sum((k - n * {m}) * (k - n * {m}) / n) AS s, sum({m} * (1 - {m})) AS e, sum((n - 1) * {m} * (1 - {m})) AS w FROM {t} WHERE n > 0))"""
#: op4: rules by beginnings of paths and endings of hosts, counts by host, domain and suffix, three shrinkages and the bound.
_URLS = f"""WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{urlrep.UPPER}', '{urlrep.LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules AS (SELECT * FROM (VALUES {", ".join(str(r) for r in RULES)}) AS t(r_host, r_path, action)),
matched AS (SELECT host, path, arg_max(r_host || r_path, length(r_host || r_path)) AS rule, arg_max(action, length(r_host || r_path)) AS action
  FROM (SELECT DISTINCT host, path FROM split) JOIN rules ON starts_with(path, r_path) AND (host = r_host OR ends_with(host, '.' || r_host)) GROUP BY host, path),
known AS (SELECT doc_id AS page_id, max(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY 1),
counted AS (SELECT host, count(good) AS n, coalesce(sum(good), 0) AS k FROM split LEFT JOIN known USING (page_id) GROUP BY 1),
named AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name FROM counted),
parts AS (SELECT *, string_split(name, '.') AS labels, regexp_matches(name, '^([0-9.]+|\\[.*\\])$') AS address FROM named),
sized AS (SELECT *, CASE WHEN {_TAIL.format(k=2)} IN ({", ".join(f"'{x}'" for x in urlrep.SUFFIXES)}) THEN 2 ELSE 1 END AS m FROM parts),
hosts AS (SELECT host, n, k, CASE WHEN address THEN name ELSE {_TAIL.format(k="m + 1")} END AS domain, CASE WHEN address THEN '' ELSE {_TAIL.format(k="m")} END AS suffix FROM sized),
d AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY 1, 2),
t AS (SELECT suffix, sum(n) AS n, sum(k) AS k, (SELECT (sum(k) + 1.0) / (sum(n) + 2.0) FROM hosts) AS m FROM d GROUP BY 1),
tops AS (SELECT suffix, (k + s * m) / (n + s) AS top FROM t, (SELECT {_STRENGTH.format(m="m", t="t")} AS s)),
dt AS (SELECT d.*, top FROM d JOIN tops USING (suffix)),
domains AS (SELECT domain, (k + s * top) / (n + s) AS mid FROM dt, (SELECT {_STRENGTH.format(m="top", t="dt")} AS s)),
hd AS (SELECT hosts.*, mid FROM hosts JOIN domains USING (domain)),
post AS (SELECT host, n, k + s * mid AS a, n - k + s * (1 - mid) AS b FROM hd, (SELECT {_STRENGTH.format(m="mid", t="hd")} AS s)),
judged AS (SELECT host, n, a / (a + b) AS mean, sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) AS sd FROM post)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN mean + 1.645 * sd < 0.5 THEN 'block' ELSE 'allow' END) AS verdict, n AS n_labelled, round(mean, 6) AS posterior_mean
FROM split JOIN judged USING (host) LEFT JOIN matched USING (host, path)"""

_MD5 = "CAST('0x' || substr(md5({x}), 1, 15) AS BIGINT)"
#: op1: the exponent by bisection over the list of shares, blocks and rows in the order of their MD5.
_MIX = f"""WITH RECURSIVE r AS (SELECT doc_id, source, CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS src,
  len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS n_tokens, {_MD5.format(x="concat_ws('|', '17', coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(text, ''))")} AS h FROM documents),
b AS (SELECT src, CAST((h >> 20) % 1024 AS INT) AS block, CAST(sum(n_tokens) AS BIGINT) AS size FROM r GROUP BY 1, 2),
s AS (SELECT src, sum(size) AS tokens, sum(size) / (SELECT CAST(sum(size) AS DOUBLE) FROM b) AS p FROM b GROUP BY 1),
l AS (SELECT list(p) AS ps FROM s WHERE p > 0),
x AS (SELECT 0 AS i, CAST(0 AS DOUBLE) AS lo, CAST(1 AS DOUBLE) AS hi, ps FROM l UNION ALL SELECT i + 1, CASE WHEN ok THEN mid ELSE lo END, CASE WHEN ok THEN hi ELSE mid END, ps
  FROM (SELECT *, ln(z) - mid * list_sum(list_transform(ps, lambda p: pow(p, mid) * ln(p))) / z >= {MIN_ENTROPY} * ln(len(ps)) AS ok FROM
    (SELECT *, CASE WHEN i = 0 THEN 1.0 ELSE (lo + hi) / 2 END AS mid, list_sum(list_transform(ps, lambda p: pow(p, CASE WHEN i = 0 THEN 1.0 ELSE (lo + hi) / 2 END))) AS z FROM x WHERE i < 48))),
a AS (SELECT lo AS alpha, list_sum(list_transform(ps, lambda p: pow(p, lo))) AS z FROM x WHERE i = 48),
w AS (SELECT src, CAST(tokens AS BIGINT) AS tokens, alpha, CASE WHEN p > 0 THEN pow(p, alpha) / z ELSE 0 END AS weight FROM s, a),
d AS (SELECT *, CAST(floor(weight * (SELECT sum(tokens) FROM w) + 0.5) AS BIGINT) AS budget FROM w),
st AS (SELECT src, block, size, coalesce(sum(size) OVER (PARTITION BY src ORDER BY {_MD5.format(x="concat_ws('|', '17', src, CAST(block AS VARCHAR))")}, block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM b),
p AS (SELECT r.*, start, d.tokens, d.weight, d.alpha, d.budget, start + coalesce(sum(n_tokens) OVER (PARTITION BY r.src, block ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place,
  start + sum(n_tokens) OVER (PARTITION BY r.src, block ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS until FROM r JOIN st ON r.src = st.src AND (r.h >> 20) % 1024 = st.block JOIN d ON d.src = r.src)
SELECT doc_id, source, n_tokens, round(weight, 6) AS weight, round(alpha, 6) AS alpha, CAST(place AS BIGINT) AS place, CASE WHEN budget > 0 THEN round(CAST(place AS DOUBLE) / budget, 9) END AS first_turn,
  CAST(CASE WHEN tokens > 0 THEN budget // tokens + CASE WHEN until <= budget % tokens THEN 1 ELSE 0 END ELSE 1 END AS INT) AS repeats FROM p"""
_WORD = "[^ \\t\\n\\x0B\\f\\r]+"
#: op3: the least padding by length and number of buckets, the way back through its choices, and places by hashed parts.
_PACK = f"""WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text, {_MD5.format(x="coalesce(text, '')")} AS text_key, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS n,
  regexp_extract_all(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]*{_WORD}') AS ts FROM documents),
e AS (SELECT *, unnest(range(0, greatest(1, (n + 2047) // 2048))) AS piece FROM d),
s AS (SELECT doc_id, text_key, piece, CAST(least(2048, n - piece * 2048) AS INT) AS n_tokens, {_MD5.format(x="concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), ''), CAST(text_key AS VARCHAR), CAST(piece AS VARCHAR))")} % 1024 AS part,
  CASE WHEN n = 0 THEN text ELSE array_to_string(ts[piece * 2048 + 1:(piece + 1) * 2048], '') || CASE WHEN (piece + 1) * 2048 >= n THEN substr(text, length(array_to_string(ts, '')) + 1) ELSE '' END END AS text FROM e),
h AS (SELECT row_number() OVER (ORDER BY n_tokens) AS j, n_tokens AS len, sum(count(*)) OVER (ORDER BY n_tokens) AS upto FROM s GROUP BY n_tokens),
u AS (SELECT 0 AS j, 0 AS len, 0 AS upto UNION ALL SELECT * FROM h),
best AS (SELECT 0 AS b, CAST(0 AS BIGINT) AS j, CAST(0 AS BIGINT) AS cost, CAST(NULL AS BIGINT) AS came UNION ALL
  SELECT b + 1, x.j, x.cost, x.came FROM (SELECT best.b, h.j, CAST(min(best.cost + h.len * (h.upto - u.upto)) AS BIGINT) AS cost, CAST(arg_min(best.j, (best.cost + h.len * (h.upto - u.upto)) * 4096 + best.j) AS BIGINT) AS came
    FROM best JOIN u ON u.j = best.j JOIN h ON h.j > best.j WHERE best.b < 16 GROUP BY best.b, h.j) x),
back AS (SELECT b, j, came FROM best WHERE b = (SELECT least(16, count(*)) FROM h) AND j = (SELECT max(j) FROM h) UNION ALL SELECT p.b, p.j, p.came FROM back JOIN best p ON p.b = back.b - 1 AND p.j = back.came WHERE back.b > 1),
edges AS (SELECT len AS bucket, coalesce(lag(len) OVER (ORDER BY len), -1) AS low FROM back JOIN h USING (j)),
r AS (SELECT s.*, bucket FROM s JOIN edges ON n_tokens > low AND n_tokens <= bucket),
p AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY part, doc_id NULLS FIRST, piece, text_key) - 1 AS spot,
  row_number() OVER (PARTITION BY bucket, part ORDER BY doc_id NULLS FIRST, piece, text_key) - rank() OVER (PARTITION BY bucket, part ORDER BY doc_id NULLS FIRST, piece, text_key) AS copy FROM r)
SELECT doc_id, CAST(copy AS INT) AS copy, CAST(piece AS INT) AS piece, n_tokens, bucket, bucket - n_tokens AS padding, CAST(spot // greatest(1, 65536 // greatest(bucket, 1)) AS BIGINT) AS batch_id,
  CAST(spot % greatest(1, 65536 // greatest(bucket, 1)) AS INT) AS slot, CAST(length(text) AS INT) AS n_chars, md5(text) AS text_md5 FROM p"""
#: op7: every pair, components added up in order.
_NEAREST = """WITH u AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
m AS (SELECT len(v) AS dim FROM u GROUP BY 1 ORDER BY count(*) DESC, dim LIMIT 1), c AS (SELECT u.* FROM u JOIN m ON len(v) = dim),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(c.v) + 1), lambda i: q.v[i] * c.v[i])) AS score FROM c AS q JOIN c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(r AS INT) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 20"""


def _empty(states: tuple[int, ...]) -> str:
    return "".join(f"<|{chat.ROLES[s - 1]}|>\n\n<|end|>\n" for s in states)


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


_FAR = 1e18
_STATES = range(chat.STATES)
_MOVES = ", ".join(
    f"({-1 if role is None else role}, {s}, {t}, {min(_FAR, c)}, '{action}', {len(fill)}, {_text(_empty(fill))})" for role, m in chat.MOVES.items() for s, row in enumerate(m) for t, (c, action, fill) in enumerate(row)
)
_CLOSE = ", ".join(f"({s}, {min(_FAR, chat.FILL[s][chat.FINAL][0])}, {len(chat.FILL[s][chat.FINAL][1])}, {_text(_empty(chat.FILL[s][chat.FINAL][1]))})" for s in _STATES)
_WAYS = "[" + ", ".join("[" + ", ".join(f"c[{s + 1}] + m[{4 * s + t + 1}]" for s in _STATES) + "]" for t in _STATES) + "]"
#: op10: costs forward turn by turn, the path backward, and the rendered pieces along it.
_CHAT = f"""WITH RECURSIVE moves(role, s, t, cost, action, fills, fill_text) AS (VALUES {_MOVES}), ends(s, cost, n, close_text) AS (VALUES {_CLOSE}), roles(id, name) AS (VALUES {", ".join(str((i, n)) for i, n in enumerate(chat.ROLES))}),
costs AS (SELECT role, list(cost ORDER BY s, t) AS m FROM moves GROUP BY role), closing AS (SELECT list(cost ORDER BY s) AS e FROM ends),
t AS (SELECT conv_id, turn, role AS role_in, coalesce(id, -1) AS role, text, dense_rank() OVER (ORDER BY conv_id) AS cid, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i, count(*) OVER (PARTITION BY conv_id) AS n
  FROM conversations LEFT JOIN roles ON lower(trim(role)) = name),
f AS (SELECT DISTINCT cid, CAST(0 AS BIGINT) AS i, [0.0, {_FAR}, {_FAR}, {_FAR}]::DOUBLE[] AS c, NULL::INT[] AS came FROM t
  UNION ALL SELECT cid, i, list_transform(ways, lambda w: list_min(w)), list_transform(ways, lambda w: CAST(list_position(w, list_min(w)) - 1 AS INT)) FROM
    (SELECT f.cid, t.i, {_WAYS} AS ways FROM f JOIN t ON t.cid = f.cid AND t.i = f.i + 1 JOIN costs ON costs.role = t.role)),
last AS (SELECT f.cid, f.i, CAST(list_position(w, list_min(w)) - 1 AS INT) AS at FROM (SELECT f.*, [{", ".join(f"c[{s + 1}] + e[{s + 1}]" for s in _STATES)}] AS w FROM f, closing) f JOIN (SELECT DISTINCT cid, n FROM t) x ON x.cid = f.cid AND x.n = f.i),
b AS (SELECT * FROM last UNION ALL SELECT f.cid, f.i - 1, f.came[b.at + 1] FROM b JOIN f ON f.cid = b.cid AND f.i = b.i WHERE b.i > 0),
p AS (SELECT t.*, b.at, f.came[b.at + 1] AS before FROM t JOIN b ON b.cid = t.cid AND b.i = t.i JOIN f ON f.cid = t.cid AND f.i = t.i)
SELECT conv_id, turn, p.i - 1 AS seq, role_in, name AS role_out, action, CAST(moves.cost + CASE WHEN p.i = p.n THEN ends.n * {chat.INSERT} ELSE 0 END AS DOUBLE) AS cost, CAST(fills AS INT) AS empty_before, CAST(CASE WHEN p.i = p.n THEN ends.n ELSE 0 END AS INT) AS empty_after,
  CASE WHEN action = 'merge' THEN chr(10) ELSE CASE WHEN p.i > 1 THEN chr(10) || '<|end|>' || chr(10) ELSE '' END || fill_text || '<|' || name || '|>' || chr(10) END
  || regexp_replace(coalesce(text, ''), '<(\\\\*\\|)', '<\\\\\\1', 'g') || CASE WHEN p.i = p.n THEN chr(10) || '<|end|>' || chr(10) || close_text ELSE '' END AS rendered
FROM p JOIN moves ON moves.role = p.role AND moves.s = p.before AND moves.t = p.at JOIN ends ON ends.s = p.at JOIN roles ON roles.id = p.at - 1"""

#: op12: the stated integers, term by term.
_TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_RANKED = f"""WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), '{urlrep.UPPER}', '{urlrep.LOWER}'), '{_TERM}') AS ts FROM documents),
s AS (SELECT count(*) AS big_n, CAST(sum(len(ts)) AS BIGINT) AS big_l FROM d WHERE len(ts) > 0),
p AS (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS term FROM d), f AS (SELECT r, doc_id, n, term, count(*) AS tf FROM p GROUP BY ALL),
i AS (SELECT item_id, term, count(*) AS c FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{urlrep.UPPER}', '{urlrep.LOWER}'), '{_TERM}')) AS term FROM benchmark) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, s GROUP BY term, big_n),
q AS (SELECT item_id, r, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l)))) AS BIGINT) AS score FROM i JOIN f USING (term) JOIN w USING (term), s GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM q WHERE score > 0) WHERE rank <= 10"""

ORACLE_SQL: dict[str, str] = {"op12_ball_tree": _RANKED, "op10_chat_repair": _CHAT, "op7_rotated_bits": _NEAREST, "op3_packing": _PACK, "op1_mixing": _MIX, "op4_url_reputation": _URLS}
