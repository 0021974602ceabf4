"""Tables kept in parts (days, years), each part a folder; a manifest names the folders that are the table just now.

A change writes its rows once, into a folder of its own, and then puts a new manifest beside the old ones.  That one step replaces any number of parts
and lets parts vanish; who reads sees the table before it or after it.  A run that ends before it leaves the table as it was, and a manifest that another
writer has put there meanwhile makes the step fail.  Earlier manifests and their folders stay until vacuum(), so a version can be restored.
Manifests hold names alone: one line for each day of a calendar at most.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PART = "part_key"


@dataclass(frozen=True)
class Manifest:
    """parts: key of a part and its folder below the root; source: the parts of the table that this one was derived from."""

    version: int = 0
    parts: dict[str, str] = field(default_factory=dict)
    schema: str | None = None
    note: str = ""
    batch: int | None = None
    source: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Staged:
    """Rows written beside the table: the folder of each part, how many rows, and their schema."""

    folder: str
    parts: dict[str, str]
    rows: int
    schema: str


class Conflict(RuntimeError):
    """Another writer has put its manifest first."""


def _fs(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, jvm_path = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(jvm_path)) if fs.exists(jvm_path) else []


def _versions(spark: SparkSession, root: str) -> list[int]:
    return [int(n[1:-5]) for n in _names(spark, f"{root}/manifests") if n.startswith("v") and n.endswith(".json")]


def manifest(spark: SparkSession, root: str, version: int | None = None) -> Manifest:
    """The latest manifest, or that of a version; a table that is not there yet has an empty one."""
    have = _versions(spark, root)
    if version is None and not have:
        return Manifest()
    fs, path = _fs(spark, f"{root}/manifests/v{have[-1] if version is None else version:010d}.json")
    stream = fs.open(path)
    try:
        return Manifest(**json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def history(spark: SparkSession, root: str) -> list[Manifest]:
    """All manifests that are still there, the oldest first."""
    return [manifest(spark, root, v) for v in _versions(spark, root)]


def read(spark: SparkSession, root: str, keys: Iterable[str] | None = None, at: Manifest | None = None, like: DataFrame | None = None) -> DataFrame:
    """The rows of the table, or of the parts with some keys; files of other parts are not even listed."""
    at = at or manifest(spark, root)
    wanted = at.parts if keys is None else {k: at.parts[k] for k in keys if k in at.parts}
    schema = like.schema if like is not None and at.schema is None else StructType.fromJson(json.loads(at.schema or '{"type": "struct", "fields": []}'))
    if not wanted:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{f}" for f in wanted.values()])


def stage(rows: DataFrame, root: str, key: Column, order: tuple[str | Column, ...] = (), files: int | None = None, **options) -> Staged:
    """Write rows beside the table, once: ranges of (key, order), sorted within, in so many files (without a number, in Spark's partitions)."""
    spark, folder, seen = rows.sparkSession, f"data/{uuid.uuid4().hex}", Observation()
    keyed = rows.withColumn(PART, key.cast("string"))
    if files is not None:
        keyed = keyed.repartitionByRange(files, PART, *order)
    keyed = keyed.sortWithinPartitions(PART, *order).observe(seen, F.count("*").alias("rows"))
    keyed.write.options(**options).partitionBy(PART).parquet(f"{root}/{folder}")
    parts = {n.split("=", 1)[1]: f"{folder}/{n}" for n in _names(spark, f"{root}/{folder}") if n.startswith(f"{PART}=")}
    return Staged(folder, parts, seen.get["rows"], rows.schema.json())


def staged_rows(spark: SparkSession, root: str, staged: Staged) -> DataFrame:
    """What stage() wrote, read back: what gates look at."""
    return read(spark, root, at=Manifest(parts=staged.parts, schema=staged.schema))


def discard(spark: SparkSession, root: str, staged: Staged) -> None:
    fs, path = _fs(spark, f"{root}/{staged.folder}")
    fs.delete(path, True)


def _wider(old: str | None, new: str | None) -> str | None:
    """The fields of both, the old ones first; files without a field give nulls."""
    if old is None or new is None:
        return old or new
    a, b = json.loads(old), json.loads(new)
    have = {f["name"]: f["type"] for f in a["fields"]}
    if changed := [f["name"] for f in b["fields"] if f["name"] in have and have[f["name"]] != f["type"]]:
        raise ValueError(f"columns of another type than before: {changed}")
    return json.dumps({**a, "fields": a["fields"] + [f for f in b["fields"] if f["name"] not in have]})


def commit(
    spark: SparkSession, root: str, base: Manifest, staged: Staged | None = None, drop: Iterable[str] = (), note: str = "", batch: int | None = None, source: dict[str, str] | None = None
) -> Manifest:
    """The one step: base with the staged parts in place of theirs and without the dropped ones becomes the table."""
    gone = set(drop)
    parts = {k: f for k, f in base.parts.items() if k not in gone} | (staged.parts if staged else {})
    new = Manifest(base.version + 1, parts, _wider(base.schema, staged.schema if staged else None), note, base.batch if batch is None else batch, base.source if source is None else source)
    _put(spark, root, new)
    return new


def _put(spark: SparkSession, root: str, new: Manifest) -> None:
    jvm = spark.sparkContext._jvm
    fs, beside = _fs(spark, f"{root}/manifests/.writing-{uuid.uuid4().hex}")
    stream = fs.create(beside, False)
    try:
        stream.write(bytearray(json.dumps(new.__dict__, sort_keys=True).encode()))
    finally:
        stream.close()
    _, path = _fs(spark, f"{root}/manifests/v{new.version:010d}.json")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(beside, path, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))  # never over one that is there
    except Exception as e:
        fs.delete(beside, False)
        if fs.exists(path):
            raise Conflict(f"version {new.version} of {root} is there already") from e
        raise


def restore(spark: SparkSession, root: str, version: int) -> Manifest:
    """Make the table again what it was at a version; this is a version of its own."""
    old, now = manifest(spark, root, version), manifest(spark, root)
    new = Manifest(now.version + 1, old.parts, now.schema, f"restored: {version}", now.batch, old.source)
    _put(spark, root, new)
    return new


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete manifests before the last so many, and folders that no other one names; nobody may be writing. How many folders went."""
    versions = _versions(spark, root)
    for v in versions[:-keep]:
        fs, path = _fs(spark, f"{root}/manifests/v{v:010d}.json")
        fs.delete(path, False)
    used = {f for m in history(spark, root) for f in m.parts.values()}
    gone = 0
    for folder in _names(spark, f"{root}/data"):
        inside = [n for n in _names(spark, f"{root}/data/{folder}") if n.startswith(f"{PART}=")]
        for n in inside:
            if f"data/{folder}/{n}" not in used:
                fs, path = _fs(spark, f"{root}/data/{folder}/{n}")
                gone += bool(fs.delete(path, True))
        if not any(f"data/{folder}/{n}" in used for n in inside):
            fs, path = _fs(spark, f"{root}/data/{folder}")
            fs.delete(path, True)
    return gone


def changed(before: dict[str, str], now: dict[str, str]) -> set[str]:
    """Keys whose part is new, another one, or gone."""
    return {k for k in before.keys() | now.keys() if before.get(k) != now.get(k)}


def refresh(spark: SparkSession, base: str, derived: str, make: Callable[[DataFrame], DataFrame], key: Column, group: Callable[[str], str] = lambda k: k) -> set[str]:
    """Bring a derived table up to date with its base; only parts that hold changed parts of the base are made again, from these alone.

    group tells which part of the derived table a part of the base belongs to; make gives the rows of the derived table from rows of whole groups, and
    key the part of each. The parts that were made again are returned. An idle call writes nothing.
    """
    now, have = manifest(spark, base), manifest(spark, derived)
    due = {group(k) for k in changed(have.source, now.parts)}
    if not due:
        return due
    made = make(read(spark, base, [k for k in now.parts if group(k) in due], now))
    staged = stage(made, derived, key)
    if strange := staged.parts.keys() - due:
        discard(spark, derived, staged)
        raise ValueError(f"rows of parts that were not due: {sorted(strange)[:5]}")
    commit(spark, derived, have, staged, due, f"refreshed to version {now.version}", source=now.parts)
    return due
