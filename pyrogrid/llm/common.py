"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.store import one_process

#: Rows and bytes of a record batch handed to Python; a batch of very long texts then stays small.
BATCH_ROWS, BATCH_BYTES = 1000, 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(df: DataFrame) -> DataFrame:
    """Bound the record batches that Python workers get from now on in df's session."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, set from spark.checkpoint.dir where it is not set yet."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not one_process(spark):
            raise RuntimeError("spark.checkpoint.dir names no folder that all executors see")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="pyrogrid-checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared folder of spark.checkpoint.dir, so that it outlives executors.

    A local folder is chosen only where the session names none and is local, as in tests.
    """
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def held_out(doc_id: Column) -> Column:
    """The fold that no model learns from: crc32 of the id's text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def unused(df: DataFrame) -> str:
    """A beginning that no column of df has, for columns in between."""
    start = "__"
    while any(c.lower().startswith(start) for c in df.columns):
        start += "_"
    return start


#: A table of one row per key is broadcast up to so many rows; a key that holds over a SHARE-th of the other side's rows is salted.
BROADCAST_ROWS, SHARE, SALTS = 50_000, 1000, 64


def looked_up(big: DataFrame, small: DataFrame, key: str | list[str], how: str = "inner", most: int = BROADCAST_ROWS, rows: str | None = None) -> DataFrame:
    """big with the columns of small, which has one row per key; a key may hold any part of big.

    A small table of few rows is broadcast.  Otherwise both are shuffled by key and salt: keys with over a SHARE-th of the rows, of
    which there are fewer than SHARE, are dealt to SALTS parts, and their rows of small are repeated for each.  A column ``rows`` of small
    may tell how many rows of big have the key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if small.limit(most + 1).count() <= most:
        return big.join(F.broadcast(small), keys, how)
    total = big.count()
    counted = small.withColumn("__n", F.col(rows)) if rows else big.groupBy(*keys).agg(F.count("*").alias("__n"))
    counts = counted.filter(F.col("__n") * SHARE > total)
    hot_keys = [r[0] for r in counts.select(F.xxhash64(*keys)).collect()]  # fewer than SHARE
    if not hot_keys:
        return big.join(small, keys, how)
    # told by a hash: a key that shares it is salted too, on both sides
    hot = F.xxhash64(*keys).isin(*hot_keys)
    salts = F.when(hot, F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    left = big.withColumn("__salt", F.when(hot, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))).otherwise(F.lit(0).cast("long")))
    return left.join(small.withColumn("__salt", F.explode(salts)), [*keys, "__salt"], how).drop("__salt")


def dropped(df: DataFrame) -> None:
    """Delete a table that written() made, once nothing will read it again: what was made of it is materialised too."""
    context = df.sparkSession.sparkContext
    for name in {f.rsplit("/", 2)[1] for f in df.inputFiles()}:
        path = context._jvm.org.apache.hadoop.fs.Path(f"{context._jsc.sc().getCheckpointDir().get()}/{name}")
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame) -> DataFrame:
    """Materialise df as a Parquet table in the shared folder: like cut(), with columns that can be read alone. It goes with the session's JVM."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return spark.read.parquet(path)
