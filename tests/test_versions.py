"""Versioned tables, upserts by partition, and layers that are checked before a restart."""
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfcast.plans import manifest
from shelfcast.plans.pipeline import PipelineError, run_pipeline
from shelfcast.session import scratch_path
from shelfcast.sources import files, storage, versions
from test_sources_pipeline import _raw


def table(spark, n, plus=0):
    return spark.range(n).select("id", (F.col("id") % 3).cast("int").alias("year"), (F.col("id") * 2 + plus).alias("v"))


def rows(df):
    return sorted(map(tuple, df.collect()))


def local(path):
    return path.replace("file:", "")


def test_a_write_that_dies_leaves_the_old_version(spark):
    root = scratch_path(spark, "v")
    assert versions.publish_version(table(spark, 100), root) == 1
    broken = table(spark, 100).withColumn("v", F.when(F.col("id") < 90, F.col("v")).otherwise(F.raise_error(F.lit("lost")).cast("long")))
    with pytest.raises(PySparkException):
        versions.publish_version(broken, root)
    assert versions.versions(spark, root) == [1] and rows(versions.open_version(spark, root)) == rows(table(spark, 100))
    # a writer that died within its manifest is no version, and its number isn't used again
    with open(local(f"{root}/_manifests/00000002.json"), "w") as f:
        f.write('{"version": 2, "fol')
    assert versions.versions(spark, root) == [1]
    assert versions.publish_version(table(spark, 5), root) == 3 and versions.open_version(spark, root).count() == 5


def test_readers_stay_on_their_versions(spark):
    root = scratch_path(spark, "v")
    for n in (10, 20, 30):
        versions.publish_version(table(spark, n), root)
    old, new = versions.open_version(spark, root, 1), versions.open_version(spark, root)
    assert (old.count(), versions.open_version(spark, root, 2).count(), new.count()) == (10, 20, 30)
    assert versions.expire(spark, root, keep=2) == [1]
    assert versions.versions(spark, root) == [2, 3] and (versions.open_version(spark, root, 2).count(), new.count()) == (20, 30)
    with pytest.raises(FileNotFoundError):
        versions.open_version(spark, root, 1)
    assert sum(n.startswith("v") for n in os.listdir(local(root))) == 2
    with pytest.raises(FileExistsError):                       # two writers of one number: one wins
        storage.write_json(spark, versions._manifest(root, 3), {})


def test_a_published_table_moves_to_its_new_version(spark):
    root, name = scratch_path(spark, "v"), "published_" + scratch_path(spark, "t").rsplit("-", 1)[1]
    assert files.publish_table(table(spark, 10), name, root).count() == 10
    pinned = versions.open_version(spark, root, 1)
    assert files.publish_table(table(spark, 20, 1), name, root).count() == 20
    assert rows(spark.table(name)) == rows(table(spark, 20, 1)) and rows(pinned) == rows(table(spark, 10))
    wider = table(spark, 7).withColumn("w", F.lit("x"))
    assert files.publish_table(wider, name, root).columns == ["id", "year", "v", "w"]
    bucketed = files.publish_table(table(spark, 50), name, root, bucket_by="id", buckets=4, sort_by=["id"])
    plan = bucketed.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert rows(bucketed) == rows(table(spark, 50)) and "Exchange hashpartitioning" not in plan
    spark.sql(f"DROP TABLE {name}")


def test_partitioned_versions(spark):
    root, name = scratch_path(spark, "v"), "parted_" + scratch_path(spark, "t").rsplit("-", 1)[1]
    versions.publish_version(table(spark, 30), root, partition_by=["year"])
    got = versions.register_version(spark, name, root)
    assert rows(got.select("id", "year", "v")) == rows(table(spark, 30)) == rows(versions.open_version(spark, root).select("id", "year", "v"))
    spark.sql(f"DROP TABLE {name}")


def test_upsert_rewrites_touched_partitions_only(spark):
    path = files.write_parquet(table(spark, 300), scratch_path(spark, "u"), partition_by=["year"])
    listed = lambda: {y: sorted(os.listdir(local(f"{path}/year={y}"))) for y in range(3)}
    before = listed()
    changes = spark.createDataFrame([(4, 1, -1), (1, 1, -2), (1000, 1, -3)], "id long, year int, v long")
    assert versions.upsert(spark, path, changes, ["id"], "year") == [1]
    after = listed()
    assert after[0] == before[0] and after[2] == before[2] and after[1] != before[1]
    want = table(spark, 300).where("id NOT IN (1, 4)").unionByName(changes)
    assert rows(spark.read.parquet(path).select("id", "year", "v")) == rows(want)
    assert versions.upsert(spark, path, changes.limit(0), ["id"], "year") == []
    new = spark.createDataFrame([(7, 9, 1)], "id long, year int, v long")
    assert versions.upsert(spark, path, new, ["id", "year"], "year") == [9]
    assert spark.read.parquet(path).count() == 302
    for bad in (changes.unionByName(changes), changes.withColumn("year", F.lit(None).cast("int"))):
        with pytest.raises(ValueError):
            versions.upsert(spark, path, bad, ["id"], "year")


def test_fingerprint_is_one_of_the_multiset(spark):
    df = table(spark, 500)
    same = manifest.facts(df.repartition(7).orderBy(F.rand(1)))
    assert manifest.facts(df) == same and same["rows"] == 500
    for other in (table(spark, 500, 1), df.where("id > 0").unionByName(df.where("id = 1")), df.withColumn("year", F.lit(None).cast("int")),
                  df.select("id", F.col("v").cast("int").alias("year"), F.col("year").cast("long").alias("v"))):
        assert manifest.facts(other) != same
    seen_df, seen = manifest.observed(df)
    seen_df.write.parquet(scratch_path(spark, "o"))
    assert seen.get == same
    assert manifest.facts(df.limit(0)) == {"rows": 0, "f0": 0, "f1": 0, "f2": 0}


def test_a_restart_checks_the_layer_below(spark):
    work = scratch_path(spark, "work")
    run_pipeline(spark, _raw(spark), work)
    gold = run_pipeline(spark, "unused", work, start_at="gold")
    assert set(gold.seconds) == {"gold"}
    silver = f"{work}/silver/silver_sales_daily.parquet"
    for layer in ("bronze", "silver", "gold"):
        manifest.check(spark, work, layer)
    # one row of Silver is altered, then lost; then Silver is half written
    held = spark.read.parquet(silver).cache()
    one = (F.col("id") == "I1_CA_1") & (F.dayofmonth("date") == 5)
    for wrong in (held.withColumn("units", F.when(one, F.col("units") + 1).otherwise(F.col("units"))), held.where(~one)):
        copy = scratch_path(spark, "copy")
        wrong.write.parquet(copy)
        spark.read.parquet(copy).write.mode("overwrite").parquet(silver)
        with pytest.raises(PipelineError, match="layer silver") as e:
            run_pipeline(spark, "unused", work, start_at="gold")
        assert e.value.layer == "silver"
    manifest.forget(spark, work, "bronze")
    with pytest.raises(PipelineError, match="not complete") as e:
        run_pipeline(spark, "unused", work, start_at="silver")
    assert e.value.layer == "bronze"
    storage.delete(spark, silver)
    with pytest.raises(PipelineError, match="gone"):
        run_pipeline(spark, "unused", work, start_at="gold")
