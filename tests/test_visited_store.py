"""The visited set outlives its process: a second one reads, appends and compacts; a crash leaves the old version."""

import os
import subprocess
import sys

import pytest

from webcorpus.operators import visited as V
from webcorpus.session import list_names, scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SET = "meta string, key string"
OTHER = """
import sys
sys.path.insert(0, {root!r})
from webcorpus.operators import visited as V
from webcorpus.session import build_session
spark = build_session("local[2]", shuffle_partitions=2, extra={{"spark.sql.warehouse.dir": {warehouse!r}}})
{body}
"""


def keys(spark, ids, meta="blog"):
    return spark.createDataFrame([(meta, f"k{i}") for i in ids], SET)


def members(df):
    return sorted((r.meta, r.key) for r in df.collect())


def in_another_process(body, tmp_path):
    script = OTHER.format(root=ROOT, warehouse=str(tmp_path / "warehouse"), body=body)
    return subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)


def test_a_second_process_sees_appends_and_compacts(spark, tmp_path):
    path = str(tmp_path / "set")
    first = in_another_process(f"""
t = V.VisitedTable(spark, {path!r}, buckets=4)
t.append(spark.createDataFrame([("blog", f"k{{i}}") for i in range(30)], "meta string, key string"))
print("RESULT", t.read().count())
""", tmp_path)
    assert "RESULT 30" in first.stdout, first.stderr[-2000:]
    table = V.VisitedTable(spark, path)   # another catalog, and another default of buckets
    assert len(members(table.read())) == 30
    assert table.append(keys(spark, range(20, 40))) == 1
    assert table.compact() == 2 and len(members(table.read())) == 40
    third = in_another_process(f"""
t = V.VisitedTable(spark, {path!r})
c = V.keyed(spark.createDataFrame([(f"https://x.net/k{{i}}", i) for i in range(35, 45)], "url string, seq int"), "url", "blog")
print("RESULT", sorted(r.key for r in V.first_seen(c, t.read()).collect()))
t.append(V.first_seen(c, t.read()))
""", tmp_path)
    assert f"RESULT {[f'k{i}' for i in range(40, 45)]}" in third.stdout, third.stderr[-2000:]
    assert len(members(table.read())) == 45 and len(members(table.read(0))) == 30
    table.vacuum(1)
    assert table.versions() == [3] and len(members(table.read())) == 45
    with pytest.raises(ValueError):
        table.read(0)


def test_a_crash_between_data_and_manifest_leaves_the_old_version(spark, monkeypatch):
    table = V.VisitedTable(spark, scratch_path(spark, "t_crash"), buckets=2)
    table.append(keys(spark, range(5)))

    def crash(*_):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(V, "write_new", crash)
        with pytest.raises(OSError):
            table.append(keys(spark, range(100, 200)))
        with pytest.raises(OSError):
            table.compact()
    assert members(V.VisitedTable(spark, table.path).read()) == members(keys(spark, range(5))) and table.versions() == [0]
    assert len(list_names(spark, f"{table.path}/data")) > 2     # the lost segments are there, unnamed
    table.append(keys(spark, [7]))
    table.vacuum()
    assert [r.key for r in table.read().orderBy("key").collect()] == ["k0", "k1", "k2", "k3", "k4", "k7"]
    assert len([n for n in list_names(spark, f"{table.path}/data") if n.startswith("seg=")]) == 2


def test_two_writers_both_get_in(spark, monkeypatch):
    path = scratch_path(spark, "t_writers")
    one, two = V.VisitedTable(spark, path, buckets=2), V.VisitedTable(spark, path, buckets=2)
    one.append(keys(spark, [1]))
    real, met = V.write_new, []

    def slower(spark_, where, text):
        if not met:   # the other writer commits this version first
            met.append(where)
            assert two.append(keys(spark, [2], "user")) == 1
        return real(spark_, where, text)

    monkeypatch.setattr(V, "write_new", slower)
    assert one.append(keys(spark, [3])) == 2 and met[0].endswith("1")
    assert members(one.read()) == [("blog", "k1"), ("blog", "k3"), ("user", "k2")]
    monkeypatch.setattr(V, "write_new", real)
    seen, segment = [], V.VisitedTable._segment

    def late(self, *a):   # keys stored while the set is rewritten stay
        out = segment(self, *a)
        if not seen:
            seen.append(1)
            two.append(keys(spark, [4]))
        return out

    monkeypatch.setattr(V.VisitedTable, "_segment", late)
    one.compact()
    assert len(members(one.read())) == 4


def test_odd_sets(spark):
    table = V.VisitedTable(spark, scratch_path(spark, "t_odd"), buckets=2)
    assert table.read() is None and table.versions() == [] and table.compact() is None
    table.vacuum()
    table.append(keys(spark, []))
    assert table.read().count() == 0 and table.compact() == 1
    table.append(spark.createDataFrame([("ünï", "a/b?q='x'&é=1"), ("ünï", "a/b?q='x'&é=1"), ("", "")], SET))
    assert table.read().count() == 3 and table.read().distinct().count() == 2
    table.drop()
    assert table.read() is None
