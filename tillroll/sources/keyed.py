"""Keyed tables in hash buckets: a merge rewrites the buckets it touches.

A table is a folder of written versions and a folder of manifests. Rows lie in
``BUCKETS`` buckets by a hash of the key; a version holds the buckets that one
merge rewrote, and a manifest says for every bucket which version has it and how
many rows it has there. A merge reads the touched buckets of the latest manifest,
joins them with the updates, writes them as a new version and then creates the
next manifest (one small file, renamed into place: it is there whole or not at
all). A merge that fails leaves the manifest before it; readers follow the latest
manifest and never see part of a merge.

Row counts come with the write (observed, by bucket) and are checked against what
the manifest and the updates say before the new manifest is made.

Defined results: keys are not null and occur once in an update (else the merge
fails); an update without rows fails where ``merge`` is asked for one; keys absent
from the update stay; ``created_at`` is kept, ``updated_at`` is set.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.session import materialize, observed, release
from tillroll.sources.tables import _fs
from tillroll.sources.upsert import upsert

#: Buckets of a new table; a table keeps the number it was made with.
BUCKETS = 16


@dataclass
class Manifest:
    version: int
    key: str
    schema: str
    buckets: int
    #: Version that holds each bucket, and its rows there; a bucket without rows is absent.
    at: dict[int, int] = field(default_factory=dict)
    rows: dict[int, int] = field(default_factory=dict)


def _number(name: str, prefix: str, suffix: str = "") -> int | None:
    middle = name[len(prefix) : len(name) - len(suffix)]
    return int(middle) if name.startswith(prefix) and name.endswith(suffix) and middle.isdigit() else None


def _listed(spark: SparkSession, folder: str, prefix: str, suffix: str = "") -> list[int]:
    fs, path = _fs(spark, folder)
    if not fs.exists(path):
        return []
    numbers = (_number(s.getPath().getName(), prefix, suffix) for s in fs.listStatus(path))
    return sorted(n for n in numbers if n is not None)


def _manifest_path(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/manifests/m{version:08d}.json"


def _data_path(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/data/v{version:08d}"


def manifests(spark: SparkSession, base: str) -> list[int]:
    return _listed(spark, f"{base.rstrip('/')}/manifests", "m", ".json")


def manifest(spark: SparkSession, base: str, version: int | None = None) -> Manifest | None:
    """The latest manifest (or one of a version); None where there is no table."""
    known = manifests(spark, base)
    if not known:
        return None
    fs, path = _fs(spark, _manifest_path(base, known[-1] if version is None else version))
    stream = fs.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    found = json.loads(text)
    return Manifest(**{**found, **{c: {int(k): v for k, v in found[c].items()} for c in ("at", "rows")}})


def _publish(spark: SparkSession, base: str, new: Manifest) -> None:
    """Create the manifest's file; fails where its version is there already."""
    fs, target = _fs(spark, _manifest_path(base, new.version))
    _, part = _fs(spark, _manifest_path(base, new.version) + ".part")
    stream = fs.create(part, True)
    stream.write(bytearray(json.dumps(new.__dict__).encode()))
    stream.close()
    if fs.exists(target) or not fs.rename(part, target):
        raise RuntimeError(f"version {new.version} of {base} was published by another merge")


def _read(spark: SparkSession, base: str, m: Manifest, buckets) -> DataFrame | None:
    folders = [f"{_data_path(base, m.at[b])}/bucket={b}" for b in sorted(buckets) if b in m.at]
    return spark.read.schema(StructType.fromJson(json.loads(m.schema))).parquet(*folders) if folders else None


def read(spark: SparkSession, base: str, version: int | None = None) -> DataFrame | None:
    """The table as of its latest manifest (or one of a version); None where there is none."""
    m = manifest(spark, base, version)
    return None if m is None else _read(spark, base, m, m.at)


def merge(spark: SparkSession, base: str, updates: DataFrame, key: str, now: Column | None = None, buckets: int = BUCKETS, keep: int = 2) -> Manifest:
    """Merge ``updates`` into the table at ``base``; returns the new manifest.
    Versions that none of the ``keep`` latest manifests name are deleted."""
    old = manifest(spark, base)
    n = old.buckets if old else buckets
    bucket = F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    fresh = materialize(updates.withColumn("bucket", bucket), "updates", {f"b{b}": F.count_if(F.col("bucket") == b) for b in range(n)})
    seen = observed(fresh)
    if not seen["rows"]:
        raise ValueError("no rows to merge")
    most = fresh.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.count_if(F.col(key).isNull())).first()
    if most[0] > 1 or most[1]:
        raise ValueError(f"a {key} is null or has more than one row")
    touched = [b for b in range(n) if seen[f"b{b}"]]
    version = max([0, *manifests(spark, base), *_listed(spark, f"{base.rstrip('/')}/data", "v")]) + 1
    before = _read(spark, base, old, touched) if old else None
    merged = upsert(before, fresh.drop("bucket"), key, now, mark="_state")
    path = _data_path(base, version)
    rows = _write(merged.withColumn("bucket", bucket), path, touched)
    held = sum(old.rows.get(b, 0) for b in touched) if old else 0
    if rows["rows"] != held + rows["inserted"] or rows["inserted"] + rows["renewed"] != seen["rows"]:
        raise RuntimeError(f"{base}: expected {seen['rows']} rows merged into {held}, found {rows}")
    stays = {b: v for b, v in (old.at if old else {}).items() if b not in touched}
    new = Manifest(
        version, key, merged.drop("_state").schema.json(), n,
        {**stays, **dict.fromkeys(touched, version)},
        {**{b: old.rows[b] for b in stays}, **{b: rows[f"b{b}"] for b in touched}},
    )
    _publish(spark, base, new)
    release(fresh)
    expire(spark, base, keep)
    return new


def _write(merged: DataFrame, path: str, touched: list[int]) -> dict[str, int]:
    """Write the touched buckets, a task each; row counts as the write saw them."""
    seen, state = Observation(), F.col("_state")
    merged.repartition("bucket").observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(state == "inserted").alias("inserted"),
        F.count_if(state == "renewed").alias("renewed"),
        *(F.count_if(F.col("bucket") == b).alias(f"b{b}") for b in touched),
    ).drop("_state").write.mode("error").partitionBy("bucket").parquet(path)
    return seen.get


def expire(spark: SparkSession, base: str, keep: int = 2) -> None:
    """Delete all but the ``keep`` latest manifests, and the buckets that no manifest left names."""
    known = manifests(spark, base)
    left = [manifest(spark, base, v) for v in known[-keep:]]
    named = {(v, b) for m in left for b, v in m.at.items()}
    for v in known[:-keep]:
        fs, path = _fs(spark, _manifest_path(base, v))
        fs.delete(path, False)
    for v in _listed(spark, f"{base.rstrip('/')}/data", "v"):
        if v > left[-1].version:
            continue  # a merge under way
        folder = _data_path(base, v)
        inside = _listed(spark, folder, "bucket=")
        for b in inside:
            if (v, b) not in named:
                fs, path = _fs(spark, f"{folder}/bucket={b}")
                fs.delete(path, True)
        if not any((v, b) in named for b in inside):
            fs, path = _fs(spark, folder)
            fs.delete(path, True)
