"""The training-data queries that SQL can express give its rows."""

import random

import duckdb
import pytest

from pyrogrid.llm import chat, queries
from tests.compare import frames, same


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_as_sql(spark, name, sf):
    assert not same(*frames(spark, f"/root/testdata/{sf}", name, queries.QUERIES[name], queries.ORACLE_SQL[name]))


@pytest.mark.parametrize("parts", [3, 60])
def test_chat_ties(spark, parts):
    """Conversations cut by ranges take the path that one replay of them takes, ties and nulls included."""
    rng = random.Random(5)
    roles = ["system", "user", "assistant", "user", "assistant", " User ", "bot", None]
    rows = [(c or None, i if rng.random() < 0.8 else None, rng.choice(roles), rng.choice(["a", "b <|user|> <\\|x", "", None])) for c in range(8) for i in range(rng.choice([1, 5, 120]))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    want = con.execute(queries.ORACLE_SQL["op10_chat_repair"])
    columns = [d[0] for d in want.description]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = sorted(str(tuple(r)) for r in chat.repair(df).select(*columns).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == sorted(map(str, want.fetchall()))
