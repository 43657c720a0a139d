"""Exact stratified split properties (counts, disjointness, seed stability,
independence from the partition count)."""

import math

from pyspark.sql import functions as F

from tessera.operators.split import filter_split, stratified_split
from tessera.plans.views import v_text

SF = "/root/testdata/sf0.01"


def _assign(df):
    return {r.id: r._split for r in df.select("id", "_split").collect()}


def test_counts_exact_and_disjoint(spark):
    vt = v_text(spark, SF)
    s = stratified_split(vt, key="id", test_size=0.2, seed=7)
    sizes = {r.tag: r["count"] for r in vt.groupBy("tag").count().collect()}
    for r in s.groupBy("tag", "_split").count().collect():
        n_test = math.ceil(0.2 * sizes[r.tag])
        assert r["count"] == (n_test if r._split == "test" else sizes[r.tag] - n_test)
    tr, te = filter_split(s, "train"), filter_split(s, "test")
    assert tr.join(te, "id").count() == 0
    assert tr.count() + te.count() == vt.count()


def test_independent_of_partitioning_and_seed_stable(spark):
    vt = v_text(spark, SF)
    a = _assign(stratified_split(vt, key="id", seed=3))
    b = _assign(stratified_split(vt.repartition(13), key="id", seed=3))
    c = _assign(stratified_split(vt, key="id", seed=4))
    assert a == b
    assert a != c


def test_absolute_test_size(spark):
    vt = v_text(spark, SF)
    s = stratified_split(vt, key="id", test_size=5)
    counts = [r["count"] for r in s.where(F.col("_split") == "test").groupBy("tag").count().collect()]
    assert set(counts) == {5}


def test_unshuffled_split_takes_last_rows_by_key(spark):
    vt = v_text(spark, SF)
    s = stratified_split(vt, key="id", test_size=0.2, shuffle=False)
    got = {r.id for r in s.where(F.col("_split") == "test").collect()}
    want = set()
    by_tag = {}
    for r in vt.select("id", "tag").collect():
        by_tag.setdefault(r.tag, []).append(r.id)
    for ids in by_tag.values():
        ids.sort()
        want.update(ids[len(ids) - math.ceil(0.2 * len(ids)):])
    assert got == want
