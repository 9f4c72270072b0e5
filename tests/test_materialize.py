"""Nights that are repeated, broken or late: results, newest rows and reads as of a point in time."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearshelf.operators import materialize as ma
from clearshelf.sources import tables as tb

D = date(2001, 6, 15)
SCHEMA = T.StructType([T.StructField("a", T.DoubleType()), T.StructField("run_date", T.StringType())])
PANEL = "mds_fam_id int, club_nbr int, date date, item_on_shelf_date_dt date, created_timestamp timestamp, units double"


def results(spark, path):
    return sorted(map(tuple, tb.read_results(spark, path, schema=SCHEMA).collect()))


def test_a_repeated_night_takes_the_place_of_the_first(spark, tmp_path):
    path = str(tmp_path / "r")
    for day, n in ((1, 3), (2, 2), (1, 2), (2, 2)):
        tb.append_results(spark.range(n).selectExpr("id AS a"), path, schema=SCHEMA, run_date=date(2001, 1, day))
    assert results(spark, path) == [(0.0, "2001-01-01"), (0.0, "2001-01-02"), (1.0, "2001-01-01"), (1.0, "2001-01-02")]


def test_a_night_that_fails_half_way_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "r")
    tb.append_results(spark.range(4).selectExpr("id AS a"), path, schema=SCHEMA, run_date=date(2001, 1, 1))
    before = results(spark, path)
    broken = spark.range(0, 4, 1, 4).select(
        F.when(F.col("id") == 3, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("a")
    )
    for day in (1, 2):
        with pytest.raises(Exception, match="lost"):
            tb.append_results(broken, path, schema=SCHEMA, run_date=date(2001, 1, day))
        assert results(spark, path) == before
    stamped = broken.withColumn("run_date", F.lit("2001-01-01"))
    with pytest.raises(Exception, match="lost"):
        tb.replace_partitions(stamped, path, by=["run_date"])
    assert results(spark, path) == before


def test_a_night_without_rows_leaves_its_date_empty(spark, tmp_path):
    path = str(tmp_path / "r")
    for n in (2, 0):
        tb.append_results(spark.range(n).selectExpr("id AS a"), path, schema=SCHEMA, run_date=date(2001, 1, 1))
    tb.append_results(spark.range(1).selectExpr("id AS a"), path, schema=SCHEMA, run_date=date(2001, 1, 2))
    assert results(spark, path) == [(0.0, "2001-01-02")]


def rebuilt(rows, until):
    """The newest row of every entity."""
    newest = {}
    for r in rows:
        if r[2] <= until:
            rank = (r[2], r[3] is not None, r[3] or D, r[4])
            if r[:2] not in newest or rank > newest[r[:2]][0]:
                newest[r[:2]] = (rank, r)
    return sorted((r for _, r in newest.values()), key=str)


def test_nights_equal_a_rebuild_late_rows_included(spark, tmp_path):
    rng, path, seen = random.Random(5), str(tmp_path / "latest"), []
    for night in range(4):
        as_of, run = D + timedelta(days=night), datetime(2001, 6, 16 + night, 7)
        # today's rows, late rows of the two days before, and corrections of rows that were there
        for _ in range(25 if night != 2 else 6):
            day = as_of - timedelta(days=rng.choice((0, 0, 1, 2)))
            shelf = rng.choice((None, D - timedelta(days=9), D - timedelta(days=3)))
            key = (rng.choice((*range(12), None)), rng.randrange(3))
            if not any(r[:4] == (*key, day, shelf) and r[4] == run for r in seen):
                seen.append((*key, day, shelf, run, float(len(seen))))
        panel = spark.createDataFrame(
            [max((r for r in seen if r[:4] == k), key=lambda r: r[4]) for k in {r[:4] for r in seen}], PANEL
        )
        for _ in range(1 + night % 2):
            ma.upsert_latest(panel, path, as_of=as_of, buckets=8)
        assert sorted(map(tuple, ma.read_latest(spark, path).select(panel.columns).collect()), key=str) == rebuilt(seen, as_of)


def test_a_night_rewrites_only_the_parts_it_has_entities_of(spark, tmp_path):
    path = tmp_path / "latest"
    every = spark.createDataFrame([(i, 1, D, None, datetime(2001, 6, 16), 1.0) for i in range(60)], PANEL)
    ma.upsert_latest(every, str(path), as_of=D, buckets=16)
    before = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    one = spark.createDataFrame([(7, 1, D + timedelta(days=3), None, datetime(2001, 6, 19), 2.0)], PANEL)
    ma.upsert_latest(one, str(path), as_of=D + timedelta(days=3), buckets=16)
    after = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    assert len(before) - sum(before.get(f) == t for f, t in after.items()) == 1
    found = {r.mds_fam_id: r.units for r in ma.read_latest(spark, str(path)).collect()}
    assert len(found) == 60 and found[7] == 2.0
    ma.upsert_latest(one.limit(0), str(path), as_of=D, buckets=16)
    assert ma.read_latest(spark, str(path)).count() == 60


def test_point_in_time_equals_a_comparison_of_all(spark):
    rng = random.Random(8)
    start = datetime(2001, 6, 1)

    def at(hours):
        return start + timedelta(hours=hours)

    features = [
        (rng.choice((1, 2, None)), rng.choice((1, 2)), at(rng.randrange(400)), at(rng.randrange(400)), float(i))
        for i in range(150)
    ] + [(1, 1, None, at(5), 999.0), (1, 1, at(30), at(30), 1000.0), (1, 1, at(30), at(30), 1001.0)]
    requests = [
        (rng.choice((1, 2, 3, None)), rng.choice((1, 2, None)), at(rng.randrange(-9, 420)), f"r{i}") for i in range(80)
    ] + [(1, 1, None, "x"), (1, 1, at(30), "same"), (1, 1, at(30), "same")]
    expected = []
    for item, club, when, name in requests:
        fit = [
            f for f in features
            if None not in (item, club, when, f[2]) and f[:2] == (item, club) and when - timedelta(days=3) <= f[2] <= when
        ]
        best = max(fit, key=lambda f: f[2:], default=(None,) * 5)
        expected.append((item, club, when, name, best[2], best[4]))
    found = ma.point_in_time(
        spark.createDataFrame(requests, "mds_fam_id int, club_nbr int, event_timestamp timestamp, units string"),
        spark.createDataFrame(
            features, "mds_fam_id int, club_nbr int, event_timestamp timestamp, created_timestamp timestamp, price double"
        ),
        columns=["price"], max_age_days=3, ties=["price"],
    )
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
