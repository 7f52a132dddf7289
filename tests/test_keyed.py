"""Keyed tables: a merge rewrites what it touches, and is there whole or not at all."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tillroll.sources import keyed


def stamp(month):
    return F.lit(dt.datetime(2024, month, 1)).cast("timestamp")


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, name string")


def rows_of(df):
    return {r.id: (r.name, r.created_at.month, r.updated_at.month) for r in df.collect()}


def files(base):
    return sorted(os.path.relpath(os.path.join(d, f), base) for d, _, names in os.walk(base) for f in names if f.endswith(".parquet"))


def test_merges_touch_only_their_buckets(spark, tmp_path):
    base = f"{tmp_path}/t"
    first = keyed.merge(spark, base, frame(spark, [(i, "a") for i in range(200)]), "id", stamp(1), buckets=8)
    assert first.version == 1 and set(first.at.values()) == {1} and sum(first.rows.values()) == 200
    second = keyed.merge(spark, base, frame(spark, [(7, "b"), (1000, "c")]), "id", stamp(2))
    touched = {b for b, v in second.at.items() if v == 2}
    assert 1 <= len(touched) <= 2 and sum(second.rows.values()) == 201
    assert {f.split("/")[2] for f in files(base) if f.startswith("data/v00000002")} == {f"bucket={b}" for b in touched}
    got = rows_of(keyed.read(spark, base))
    assert got[7] == ("b", 1, 2) and got[1000] == ("c", 2, 2) and got[8] == ("a", 1, 1) and len(got) == 201
    assert len(rows_of(keyed.read(spark, base, 1))) == 200  # the version before stays readable


def test_a_failed_merge_leaves_the_table(spark, tmp_path, monkeypatch):
    base = f"{tmp_path}/t"
    keyed.merge(spark, base, frame(spark, [(i, "a") for i in range(50)]), "id", stamp(1), buckets=4)
    with monkeypatch.context() as m:  # after the data, before the manifest
        m.setattr(keyed, "_publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            keyed.merge(spark, base, frame(spark, [(1, "b")]), "id", stamp(2))
    assert rows_of(keyed.read(spark, base))[1] == ("a", 1, 1)
    with monkeypatch.context() as m:  # rows go missing in the join
        m.setattr(keyed, "upsert", lambda old, new, key, now, mark, f=keyed.upsert: f(old, new, key, now, mark).where("id <> 1"))
        with pytest.raises(RuntimeError, match="expected"):
            keyed.merge(spark, base, frame(spark, [(1, "b")]), "id", stamp(2))
    third = keyed.merge(spark, base, frame(spark, [(1, "b")]), "id", stamp(3))
    assert third.version == 4 and rows_of(keyed.read(spark, base))[1] == ("b", 1, 3)
    assert not any(f.startswith(("data/v00000002", "data/v00000003")) for f in files(base))  # left by the failures


def test_two_merges_cannot_publish_one_version(spark, tmp_path):
    base = f"{tmp_path}/t"
    m = keyed.merge(spark, base, frame(spark, [(1, "a")]), "id", stamp(1))
    with pytest.raises(RuntimeError, match="another merge"):
        keyed._publish(spark, base, m)


def test_old_versions_go(spark, tmp_path):
    base = f"{tmp_path}/t"
    for month in range(1, 6):
        keyed.merge(spark, base, frame(spark, [(i, str(month)) for i in range(0, 40, month)]), "id", stamp(month), buckets=4)
    assert keyed.manifests(spark, base) == [4, 5]
    named = {(v, b) for n in (4, 5) for b, v in keyed.manifest(spark, base, n).at.items()}
    on_disk = {(int(f.split("/")[1][1:]), int(f.split("=")[1].split("/")[0])) for f in files(base)}
    assert on_disk == named
    assert len(rows_of(keyed.read(spark, base))) == 40


def test_bad_updates_fail_and_no_table_is_none(spark, tmp_path):
    base = f"{tmp_path}/t"
    assert keyed.read(spark, base) is None
    for bad in ([(1, "a"), (1, "b")], [(None, "a")]):
        with pytest.raises(ValueError, match="null or has more than one row"):
            keyed.merge(spark, base, frame(spark, bad), "id")
    with pytest.raises(ValueError, match="no rows"):
        keyed.merge(spark, base, frame(spark, []), "id")
    assert keyed.manifests(spark, base) == []
