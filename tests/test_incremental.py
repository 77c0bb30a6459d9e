"""Silver from batches: equal to one run, pruned reads, reruns, races, compaction."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tidemark.operators import incremental as I
from tidemark.operators.clean import TRIP_COLUMNS, clean, trip_spec
from tidemark.plans import datasets as ds
from tidemark.sources.adapters import trips_from_events, trips_with_copies

TIME, NAMES = "pickup_ts", TRIP_COLUMNS


@pytest.fixture()
def root(tmp_path):
    return f"file://{tmp_path}/silver"


@pytest.fixture(scope="module")
def batches(events_small):
    trips = trips_from_events(events_small)
    return [trips.filter("trip_id % 3 = 0"), trips.filter("trip_id % 3 <> 0"),
            trips.filter("trip_id % 5 = 0")]


def add(root, number, batch):
    return I.add_batch(clean(batch, trip_spec()), root, number, TIME)


def rows_of(df):
    return sorted(map(tuple, df.select(*NAMES, "window").collect()))


def test_batches_equal_one_run(spark, root, batches, events_small):
    added = [add(root, i, b)["n_new"] for i, b in enumerate(batches)]
    assert added[2] == 0 and I.watermark(spark, root) == 2
    want = rows_of(ds.build_silver(trips_with_copies(events_small)))
    assert rows_of(I.labelled(I.read_silver(spark, root), TIME)) == want
    assert sum(added) == len(want)
    # a batch that is run again is the one that is there
    assert add(root, 1, batches[1])["n_new"] == added[1]
    I.compact(spark, root)
    assert rows_of(I.labelled(I.read_silver(spark, root), TIME)) == want
    late = batches[0].limit(3).withColumn("fare_amount", F.lit(77.0))
    assert add(root, 7, late)["n_new"] == late.distinct().filter("trip_distance is not null").count()


def test_only_touched_days_are_read(spark, root, batches):
    add(root, 0, batches[0])
    silver = I.read_silver(spark, root)
    days = [r["day"] for r in silver.select("day").distinct().orderBy("day").limit(2).collect()]
    plan = I.unseen(silver.filter(F.col("day").isin(days)), silver, days)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in text
    scans = [line for line in text.splitlines() if "PartitionFilters" in line]
    assert scans and all("day" in s.split("PartitionFilters")[1].split("PushedFilters")[0]
                         for s in scans)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_failed_attempt_is_not_read(spark, root, batches):
    add(root, 0, batches[0])
    n = I.read_silver(spark, root).count()
    broken = clean(batches[1], trip_spec()).withColumn("fare_amount", F.when(
        F.col("fare_amount") > 20, F.raise_error(F.lit("half-way"))).otherwise(F.col("fare_amount")))
    with pytest.raises(Exception, match="half-way"):
        I.add_batch(broken, root, 1, TIME)
    assert I.read_silver(spark, root).count() == n and I.watermark(spark, root) == 0


def test_concurrent_runs_add_each_row_once(spark, root, batches, events_small):
    """Three runners at once, two with the same batch, two with common rows."""
    jobs = [(0, batches[0]), (1, batches[2]), (1, batches[2])]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda j: add(root, *j), jobs))
    got = I.read_silver(spark, root)
    want = clean(batches[0].unionByName(batches[2]), trip_spec())
    assert got.count() == want.count() == got.drop("day").distinct().count()
    assert len(I._commits(spark, root)) == 2


def test_cutoff_and_empty(spark, root, batches):
    assert I.read_silver(spark, root) is None and I.compact(spark, root) is None
    add(root, 0, batches[0].limit(0))
    empty = I.read_silver(spark, root)
    assert empty.count() == 0 and I.labelled(empty, TIME).count() == 0
    add(root, 1, batches[0])
    silver = I.read_silver(spark, root)
    for fraction in (0.0001, 0.3, 0.7, 1.0):
        from tidemark.operators.timeline import time_cutoff
        want = time_cutoff(silver, TIME, fraction).first()[0]
        got = spark.range(1).select(I.cutoff_by_day(silver, TIME, fraction)).first()[0]
        assert got == want
