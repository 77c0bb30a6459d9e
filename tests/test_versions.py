"""Versions: failed writes, concurrent writers, older versions, vacuum."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tidemark.sources import versions as V


@pytest.fixture()
def root(tmp_path):
    return f"file://{tmp_path}/table"


def rows(spark, n, extra=0):
    return spark.range(n).select("id", (F.col("id") + extra).alias("v"))


def test_newest_older_and_missing(spark, root):
    with pytest.raises(V.NoSuchVersion):
        V.read_version(spark, root)
    first = V.publish(rows(spark, 5), root, note="first")
    assert (first["version"], first["n_rows"]) == (1, 5)
    second = V.publish(rows(spark, 7, 1), root)
    assert V.newest(spark, root) == second["version"] == 2
    assert V.read_version(spark, root).count() == 7
    assert V.read_version(spark, root, version=1).count() == 5
    assert V.read_version(spark, root, as_of=first["committed_at"]).count() == 5
    with pytest.raises(V.NoSuchVersion):
        V.read_version(spark, root, version=9)
    assert [r["n_rows"] for r in V.commits(spark, root).orderBy("version").collect()] == [5, 7]


def test_failed_write_leaves_the_old_rows(spark, root):
    V.publish(rows(spark, 5), root)
    broken = spark.range(0, 1000, 1, 8).select("id", F.when(F.col("id") < 900, F.col("id")).otherwise(
        F.raise_error(F.lit("half-way"))).alias("v"))
    with pytest.raises(Exception, match="half-way"):
        V.publish(broken, root)
    assert V.newest(spark, root) == 1
    assert V.read_version(spark, root).count() == 5
    # the next one commits, and the attempt is removed with what is no longer kept
    V.publish(rows(spark, 6), root)
    assert len(V.listed(spark, f"{root}/data")) == 3
    assert V.vacuum(spark, root, keep=2, older_than=3600) == []  # too young
    assert len(V.vacuum(spark, root, keep=2, older_than=0)) == 1
    assert V.read_version(spark, root, 1).count() == 5
    V.vacuum(spark, root, keep=1, older_than=0)
    assert V.read_version(spark, root).count() == 6
    with pytest.raises(V.NoSuchVersion):
        V.read_version(spark, root, 1)


def test_running_reader_is_not_disturbed(spark, root):
    V.publish(rows(spark, 5), root)
    reader = V.read_version(spark, root)
    V.publish(rows(spark, 50), root)
    assert reader.count() == 5


def test_concurrent_writers_get_versions_of_their_own(spark, root):
    with ThreadPoolExecutor(6) as pool:
        done = list(pool.map(lambda i: V.publish(rows(spark, i + 1), root)["version"], range(6)))
    assert sorted(done) == [1, 2, 3, 4, 5, 6]
    for i, version in enumerate(done):
        assert V.read_version(spark, root, version).count() == i + 1


def test_put_if_absent_has_one_winner(spark, root):
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: V.put_if_absent(spark, f"{root}/x", str(i)), range(16)))
    assert sum(won) == 1
    assert spark.read.text(f"{root}/x").first()[0] == str(won.index(True))
    assert [n for n, _ in V.listed(spark, root)] == ["x"]


def test_partitioned_empty_and_by_name(spark, root):
    spark.sql("CREATE SCHEMA IF NOT EXISTS versions_test")
    name = "versions_test.t"
    V.publish_table(rows(spark, 6).withColumn("part", F.col("id") % 3), name, root, ["part"])
    assert spark.table(name).filter("part = 1").count() == 2
    V.publish_table(rows(spark, 0).withColumn("part", F.col("id") % 3), name, root, ["part"])
    assert spark.table(name).count() == 0 and set(spark.table(name).columns) == {"id", "v", "part"}
    assert V.read_version(spark, root).count() == 0
    V.publish_table(rows(spark, 4).withColumn("part", F.col("id") % 3), name, root, ["part"])
    assert spark.table(name).count() == 4


def test_vacuum_of_intermediates(spark):
    from tidemark.session import ensure_checkpoint_dir
    from tidemark.sources.tables import materialize
    kept = materialize(rows(spark, 3))
    assert V.vacuum_intermediates(spark, older_than=3600) == []
    folder = [n for n, _ in V.listed(spark, ensure_checkpoint_dir(spark)) if n.startswith("stored-")]
    assert folder and kept.count() == 3
