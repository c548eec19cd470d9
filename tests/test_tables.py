"""Parts with a manifest, buckets that a merge leaves alone, and digests by key range."""

import os

import pytest

from lanewright.operators import buckets, digests, store
from lanewright.operators.quality import QualityError


def files(path):
    return {f"{os.path.basename(d)}/{x}" for d, _, names in os.walk(path) for x in names if x.startswith("part-")}


@pytest.fixture
def table(rows, tmp_path):
    path = str(tmp_path / "t")
    buckets.create(rows("id int, v int, note string", *[(i, i, "old") for i in range(400)]), path, ["id"], 16)
    return path


def test_an_upsert_leaves_other_buckets_alone(spark, rows, table):
    before = files(table)
    at = buckets.upsert(table, rows("id int, v int, tag string", (3, 30, "x"), (1000, 5, "y")), ["id"], 16)
    assert 1 <= len(at) <= 2
    gone = before - files(table)
    assert {f.split("/")[0] for f in gone} <= {f"_bucket={b}" for b in at} and len(before - gone) == len(before) - len(gone) > 10
    got = {r.id: (r.v, r.note, r.tag) for r in spark.read.option("mergeSchema", True).parquet(table).collect()}
    assert len(got) == 401 and got[3] == (30, "old", "x") and got[1000] == (5, None, "y") and got[4] == (4, "old", None)


def test_only_touched_buckets_are_read(spark, table):
    plan = buckets.read(spark, table, [2, 5])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r[0] for r in buckets.read(spark, table, [2, 5]).select("_bucket").distinct().collect()} == {2, 5}


def test_insertion_rewrites_buckets_of_new_keys(spark, rows, table):
    before = files(table)
    assert buckets.insert_absent(table, rows("id int, v int, note string", (3, 99, "n"), (4, 99, "n")), ["id"], 16) == []
    assert files(table) == before
    (b,) = buckets.insert_absent(table, rows("id int, v int, note string", (3, 99, "n"), (1000, 7, "n")), ["id"], 16)
    assert {f.split("/")[0] for f in before - files(table)} <= {f"_bucket={b}"}
    got = {r.id: r.v for r in buckets.read(spark, table).collect()}
    assert got[3] == 3 and got[1000] == 7 and len(got) == 401


def test_deletion_by_valid_keys(spark, rows, table):
    before = files(table)
    at = buckets.delete_stale(spark, table, rows("id int", *[(i,) for i in range(400) if i != 17]), "id", ["id"], 16)
    assert len(at) == 1 and {f.split("/")[0] for f in before - files(table)} == {f"_bucket={at[0]}"}
    assert buckets.read(spark, table).count() == 399
    with pytest.raises(QualityError):
        buckets.delete_stale(spark, table, rows("id int"), "id", ["id"], 16)
    buckets.delete_stale(spark, table, rows("id int", (1,)), "id", ["id"], 16)
    assert [r.id for r in buckets.read(spark, table).collect()] == [1]


def test_merges_without_keys_and_without_rows(rows, table):
    assert buckets.upsert(table, rows("id int, v int"), ["id"], 16) == []
    with pytest.raises(QualityError, match="lacks a key"):
        buckets.upsert(table, rows("id int, v int", (None, 1)), ["id"], 16)


def test_a_bucket_may_have_several_files(spark, rows, tmp_path):
    path = str(tmp_path / "f")
    buckets.create(rows("id int, v int", *[(i, i) for i in range(300)]), path, ["id"], 2, files=3)
    buckets.upsert(path, rows("id int, v int", *[(i, -i) for i in range(300)]), ["id"], 2, files=3)
    assert buckets.read(spark, path).agg({"v": "sum"}).first()[0] == -sum(range(300))


def test_parts_are_checked_before_they_are_seen(spark, rows, tmp_path):
    path = str(tmp_path / "p")
    load = lambda v: store.stage_parts(rows("id int, v string", *[(i, v) for i in range(200)], (None, None), (5, v), (5, v)), path, 4, ["id"])
    first = load("a")
    assert store.current(spark, path) is None
    store.commit_parts(spark, path, first)
    lost = load("b")
    store.remove(spark, f"{path}/versions/{lost}/part=2")
    with pytest.raises(QualityError, match=r"\[2\]"):
        store.commit_parts(spark, path, lost)
    doubled = load("c")
    spark.read.parquet(f"{path}/versions/{doubled}/part=1").write.mode("append").parquet(f"{path}/versions/{doubled}/part=1")
    with pytest.raises(QualityError, match=r"\[1\]"):
        store.commit_parts(spark, path, doubled)
    assert {r.v for r in store.current(spark, path).collect()} == {"a", None} and store.current(spark, path).count() == 203


def test_old_versions_go(spark, rows, tmp_path):
    path = str(tmp_path / "p")
    made = []
    for k in range(4):
        made.append(store.stage_parts(rows("id int, v int", (1, k), (2, k)), path, 2, ["id"]))
        if k != 1:  # one is staged and never published
            store.commit_parts(spark, path, made[-1], keep=2)
    assert set(store.versions(spark, path)) == {made[2], made[3]}
    assert {r.v for r in store.current(spark, path).collect()} == {3}
    with pytest.raises(ValueError):
        store.drop_old(spark, path, 0)


def test_one_changed_row_changes_one_range(rows):
    ddl, keys = "k int, v string", (["k"], ["k", "v"], 64)
    base = [(i, f"v{i}") for i in range(500)]
    a = digests.range_digests(rows(ddl, *base), *keys)
    assert digests.differing_ranges(a, digests.range_digests(rows(ddl, *reversed(base)), *keys)).isEmpty()
    b = digests.range_digests(rows(ddl, *[(k, "changed" if k == 123 else v) for k, v in base]), *keys)
    (d,) = digests.differing_ranges(a, b).collect()
    assert d.rows_a == d.rows_b
    assert digests.table_digest(a).first() != digests.table_digest(b).first()
    gone = digests.differing_ranges(a, digests.range_digests(rows(ddl, *base[1:]), *keys)).first()
    assert gone.rows_a == gone.rows_b + 1


def test_digests_tell_nulls_and_seams_apart(rows):
    one = lambda *t: digests.version_of(rows("a string, b string", *t), ["a"], ["a", "b"], 4)
    seen = [one(("x|1:y", "z")), one(("x", "y|1:z")), one((None, "-")), one(("-", None)), one(("", None)), one(("x", "y")), one(("x", "y"), ("x", "y")), one()]
    assert len(set(seen)) == len(seen) and seen[-1].startswith("0-") and seen[-2].startswith("2-")


def test_publications_in_the_same_instant_have_an_order(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    for v in range(3):
        store.publish(rows("v int", (v,)), path)
    assert store.current(spark, path).first().v == 2 and store.current(spark, str(tmp_path / "none")) is None
