"""Copy-on-write dimensions and optimistic publishing."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from quarry.operators import dimension_store
from quarry.operators.modeling import scd1_merge
from quarry.operators.quality import ConstraintViolation
from quarry.plans import load, versions
from quarry.session import scratch_path
from test_modeling import _source

THEN = dt.datetime(2020, 1, 1)


def plain(path):
    return path.removeprefix("file:")


def files(dim):
    return {f"{p}/{f}": os.stat(f"{plain(p)}/{f}").st_mtime_ns for p in dim.paths.values()
            for f in os.listdir(plain(p)) if f.startswith("part-")}


def people(spark, ids, name):
    return spark.createDataFrame([(i, f"{name}{i}", None if i % 5 == 0 else "x") for i in ids], "nid long, name string, city string")


@pytest.fixture
def people_dim(spark):
    return dimension_store.create(people(spark, range(200), "a"), "nid", "k", ["name", "city"], scratch_path(spark, "dim-test"),
                                  now=F.lit(THEN), buckets=32)


def test_first_load_is_dense_and_complete(spark, people_dim):
    rows = sorted(map(tuple, people_dim.read(spark).collect()))
    assert [(r[0], r[1]) for r in rows] == [(i + 1, i) for i in range(200)] and people_dim.max_key == people_dim.rows == 200
    assert len(people_dim.paths) == 32


def test_merge_rewrites_only_touched_buckets(spark, people_dim):
    before = files(people_dim)
    # one changed row, one new one, two that don't change
    batch = people(spark, [3, 500], "b").union(people(spark, [7, 8], "a"))
    after, touched = dimension_store.merge(people_dim, batch, scratch_path(spark, "dim-test"))
    assert 1 <= len(touched) <= 2
    kept = {f: t for f, t in files(after).items() if f in before}
    assert len(kept) == len(before) - len(touched) or len(kept) == len(before) - 1
    assert kept == {f: before[f] for f in kept}  # the very files
    rewritten = {f for f in files(after) if f not in before}
    assert len(rewritten) == len(touched)
    got = {r.nid: (r.k, r.name, r.city, r.loaded_at == THEN) for r in after.read(spark).collect()}
    assert len(got) == 201 and got[3] == (4, "b3", "x", True) and got[500] == (201, "b500", None, False) and got[7][1] == "a7"
    # the state before can still be read
    assert people_dim.read(spark).where("name = 'a3'").count() == 1


def test_merge_equals_the_full_rewrite(spark, people_dim):
    batch = people(spark, range(0, 400, 3), "c")
    after, _ = dimension_store.merge(people_dim, batch, scratch_path(spark, "dim-test"), now=F.lit(THEN))
    want = scd1_merge(people_dim.read(spark), batch, "nid", "k", ["name", "city"], now=F.lit(THEN))
    assert sorted(map(str, after.read(spark).collect())) == sorted(map(str, want.select(*after.read(spark).columns).collect()))
    again, touched = dimension_store.merge(after, batch, scratch_path(spark, "dim-test"))
    assert touched == [] and again is after
    assert dimension_store.merge(after, batch.limit(0), scratch_path(spark, "dim-test"))[1] == []


def test_merge_refuses_bad_keys(spark, people_dim):
    for rows in ([(900, "x", None), (900, "y", None)], [(None, "x", None)]):
        with pytest.raises(ConstraintViolation):
            dimension_store.merge(people_dim, spark.createDataFrame(rows, "nid long, name string, city string"), "unused")


def test_buckets_double_when_they_grow(spark, monkeypatch):
    monkeypatch.setattr(dimension_store, "ROWS_A_BUCKET", 20)
    dim = dimension_store.create(people(spark, range(50), "a"), "nid", "k", ["name", "city"], scratch_path(spark, "dim-test"), buckets=2)
    assert dim.buckets == 4
    after, _ = dimension_store.merge(dim, people(spark, range(40, 300), "b"), scratch_path(spark, "dim-test"))
    assert after.buckets == 16 and after.rows == after.read(spark).count() == 300
    assert {r.nid: r.k for r in after.read(spark).collect()} == {i: i + 1 for i in range(300)}
    for b, path in after.paths.items():
        assert spark.read.parquet(path).where(dimension_store.bucket_of("nid", 16) != int(b)).count() == 0


def test_keys_of_increments_stay_without_a_sort(spark, people_dim):
    known = {r.nid: r.k for r in people_dim.read(spark).collect()}
    dim = people_dim
    for step in range(1, 4):
        batch = people(spark, range(1000 * step, 1000 * step + 150), "n").union(people(spark, range(0, 200, 9), f"v{step}")).repartition(5)
        batch = batch.checkpoint()
        dim, _ = dimension_store.merge(dim, batch, scratch_path(spark, "dim-test"), keys_in_order=False)
        now = {r.nid: r.k for r in dim.read(spark).collect()}
        assert known.items() <= now.items() and sorted(now.values()) == list(range(1, 201 + 150 * step))
        known = now
    assert dim.max_key == 650


def test_empty_dimension(spark):
    dim = dimension_store.create(people(spark, [], "a"), "nid", "k", ["name", "city"], scratch_path(spark, "dim-test"))
    assert dim.read(spark).count() == 0
    after, _ = dimension_store.merge(dim, people(spark, [5, 4], "a"), scratch_path(spark, "dim-test"))
    assert sorted((r.k, r.nid) for r in after.read(spark).collect()) == [(1, 4), (2, 5)]


# --- publishing ------------------------------------------------------------------------------------


def test_a_number_is_given_once(spark):
    wh = scratch_path(spark, "wh-test")
    won = []
    start = threading.Barrier(6)

    def write(i):
        start.wait()
        if versions.commit(spark, wh, 1, f"{wh}/load{i}", i):
            won.append(i)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and versions.latest(spark, wh).location == f"{wh}/load{won[0]}"
    assert versions.commit(spark, wh, 2, f"{wh}/next", 0) and versions.published(spark, wh).count() == 2
    assert not [f for f in os.listdir(f"{plain(wh)}/_versions") if f.endswith(".json") and f.startswith(".")]


def test_two_refreshes_at_once_lose_nothing(spark, monkeypatch):
    wh = scratch_path(spark, "wh-test")
    load.refresh(spark, wh, _source(spark, customers=lambda df: df.where("customer_id < 20")))
    meet, real, tries = threading.Barrier(2), load.run_load, []

    def together(spark_, source, location, previous=None, calendar=None):
        star = real(spark_, source, location, previous, calendar)
        tries.append(location)
        if len(tries) <= 2:
            meet.wait(timeout=300)  # both have loaded on top of version 1 before one commits
        return star

    monkeypatch.setattr(load, "run_load", together)
    sources = [_source(spark, customers=lambda df: df.where("customer_id < 60")),
               _source(spark, customers=lambda df: df.where("customer_id >= 100"))]
    failed = []

    def run(source):
        try:
            load.refresh(spark, wh, source)
        except BaseException as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=run, args=(s,)) for s in sources]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed and len(tries) == 3
    assert [r.version for r in load.published(spark, wh).orderBy("version").collect()] == [1, 2, 3]
    # customers of both loads are in the last version, each with a key of its own
    dim = load.current(spark, wh).dim_customer
    ids = {r.customer_id for r in dim.collect()}
    want = {r[0] for s in sources for r in s.customers.select("customer_id").collect()}
    assert want <= ids and dim.select("customer_key").distinct().count() == dim.count() == len(ids)
    # the folder of the try that lost is gone
    assert sorted(f for f in os.listdir(plain(wh)) if f.startswith("v")) == sorted(
        os.path.basename(r.location) for r in load.published(spark, wh).collect())


def test_failed_load_leaves_no_folder_and_vacuum_keeps_what_is_read(spark):
    wh = scratch_path(spark, "wh-test")
    load.refresh(spark, wh, _source(spark, stores=lambda df: df.where("store_id < 5")))
    with pytest.raises(ConstraintViolation):
        load.refresh(spark, wh, _source(spark, products=lambda df: df.union(df)))
    star = load.refresh(spark, wh, _source(spark))
    third = load.refresh(spark, wh, _source(spark))
    # no customer or product changed: the third version reads the files of the first
    assert {p for d in third.dimensions.values() for p in d.paths.values()} == \
        {p for d in star.dimensions.values() for p in d.paths.values()}
    stray = f"{wh}/v000009-0123456789ab"
    os.makedirs(plain(stray))
    assert versions.vacuum(spark, wh, keep=1) == [] and os.path.exists(plain(stray))
    before = {t: sorted(map(str, getattr(third, t).collect())) for t in ("dim_customer", "dim_store", "dim_product", "fact_sales")}
    gone = versions.vacuum(spark, wh, keep=1, older_than_seconds=0)
    assert os.path.basename(stray) in gone and any(g.endswith("/fact_lines") for g in gone)
    now = load.current(spark, wh)
    assert {t: sorted(map(str, getattr(now, t).collect())) for t in before} == before
    assert load.published(spark, wh).count() == 1
    with pytest.raises(ValueError):
        versions.vacuum(spark, wh, keep=0)
