"""Tables in versions: replaced as a whole or not at all, and rewritten by year.

``publish_version`` writes a table into a new folder and then, last, one small manifest that
names it.  A table's newest version is its highest complete manifest, so a write that dies
half-way leaves the old version as it was, and whoever reads a version keeps it until it is
expired.  Two writers that meet try the same number: one manifest is made, the other
writer gets an error and its folder is never named.

``upsert`` takes late or corrected rows into a table partitioned by one column: only the
partitions that the rows touch are written again.
"""
from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.session import scratch_path
from shelfcast.sources import storage

MANIFESTS = "_manifests"
MAX_PARTITIONS = 10_000          # that one upsert may touch


def _manifest(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/{MANIFESTS}/{version:08d}.json"


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions, rising."""
    found = [int(n[:8]) for n in storage.names(spark, f"{root.rstrip('/')}/{MANIFESTS}") if n[:8].isdigit() and n.endswith(".json")]
    return [v for v in found if storage.read_json(spark, _manifest(root, v))]


def _numbered(spark: SparkSession, root: str) -> int:
    """The highest number that any manifest bears, complete or not."""
    return max([int(n[:8]) for n in storage.names(spark, f"{root.rstrip('/')}/{MANIFESTS}") if n[:8].isdigit()], default=0)


def publish_version(df: DataFrame, root: str, partition_by: Sequence[str] = (), bucket_by: str | None = None,
                    buckets: int | None = None, sort_by: Sequence[str] = (), number: int | None = None) -> int:
    """Write ``df`` as the next version of the table at ``root`` (or as ``number``); returns its number."""
    spark = df.sparkSession
    version = number or _numbered(spark, root) + 1
    folder = f"v{version:08d}-{uuid.uuid4().hex[:12]}"
    path = f"{root.rstrip('/')}/{folder}"
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by and buckets:
        w = w.bucketBy(buckets, bucket_by)
        w = w.sortBy(*sort_by) if sort_by else w
        name = "version_" + folder.replace("-", "_")
        w.option("path", path).saveAsTable(name)             # bucketed files are written through the catalog only
        spark.sql(f"DROP TABLE {name}")                      # external: the files stay
    else:
        w.parquet(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    storage.write_json(spark, _manifest(root, version), {
        "version": version, "folder": folder, "columns": columns, "bucket_by": bucket_by, "buckets": buckets if bucket_by else None,
        "sort_by": list(sort_by), "partition_by": list(partition_by)})
    return version


def _facts(spark: SparkSession, root: str, version: int | None) -> dict:
    known = versions(spark, root)
    if not known or (version is not None and version not in known):
        raise FileNotFoundError(f"{root} has no version {'' if version is None else version}".rstrip())
    return storage.read_json(spark, _manifest(root, known[-1] if version is None else version))


def open_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A version of the table, the newest if none is named.  The frame stays on it."""
    facts = _facts(spark, root, version)
    return spark.read.schema(facts["columns"]).parquet(f"{root.rstrip('/')}/{facts['folder']}")


def retract(spark: SparkSession, root: str, version: int) -> None:
    """Take a version back; its files go with the next ``expire``."""
    storage.delete(spark, _manifest(root, version))


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Delete all but the newest ``keep`` versions; returns the numbers that went.  A version is
    first unnamed, then its files go; folders that no manifest names (writes that died) go too."""
    known = versions(spark, root)
    gone = known[:-keep] if keep else known
    for v in gone:
        storage.delete(spark, _manifest(root, v))
    named = {_facts(spark, root, v)["folder"] for v in known if v not in gone}
    newest = _numbered(spark, root)
    for n in storage.names(spark, root):
        # a folder above the newest manifest may be a write that goes on
        if n.startswith("v") and n not in named and int(n[1:9]) <= newest:
            storage.delete(spark, f"{root.rstrip('/')}/{n}")
    return gone


def register_version(spark: SparkSession, name: str, root: str, version: int | None = None) -> DataFrame:
    """Let the catalog's table ``name`` stand for a version (the newest).  If its columns are the
    same the table only moves to the new folder, in one step."""
    facts = _facts(spark, root, version)
    path = f"{root.rstrip('/')}/{facts['folder']}"
    if spark.catalog.tableExists(name) and not facts["partition_by"]:
        old = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.table(name).schema.fields)
        now = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name IN ('Num Buckets', 'Bucket Columns')").collect()
        layout = {r["col_name"]: r["data_type"] for r in now}
        same = layout.get("Num Buckets") == (str(facts["buckets"]) if facts["buckets"] else None) and (
            not facts["buckets"] or layout.get("Bucket Columns") == f"[`{facts['bucket_by']}`]")
        if old == facts["columns"] and same:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            spark.catalog.refreshTable(name)
            return spark.table(name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    parts = f"PARTITIONED BY ({', '.join(facts['partition_by'])})" if facts["partition_by"] else ""
    sort = f" SORTED BY ({', '.join(facts['sort_by'])})" if facts["sort_by"] else ""
    cluster = f"CLUSTERED BY ({facts['bucket_by']}){sort} INTO {facts['buckets']} BUCKETS" if facts["buckets"] else ""
    spark.sql(f"CREATE TABLE {name} ({facts['columns']}) USING parquet {parts} {cluster} LOCATION '{path}'")
    if parts:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def upsert(spark: SparkSession, path: str, changes: DataFrame, key: Sequence[str], partition: str) -> list:
    """Take ``changes`` into the Parquet table at ``path``, partitioned by ``partition``: a row replaces
    the one with its key (which may lie in another partition only if the key says so), others are
    added.  Returns the partitions that were written again.

    Only these are read and written; the files of all others stay as they are.  The new
    partitions are staged first, since they are made from what they replace."""
    key = list(key)
    changes = changes.select(*spark.read.parquet(path).columns)
    if changes.groupBy(*key).count().where("count > 1").limit(1).count():
        raise ValueError(f"changes hold a key twice: {', '.join(key)}")
    touched = [r[0] for r in changes.select(partition).distinct().limit(MAX_PARTITIONS + 1).collect()]
    if len(touched) > MAX_PARTITIONS:
        raise ValueError(f"changes touch more than {MAX_PARTITIONS} partitions")
    if None in touched:
        raise ValueError(f"a change has no {partition}")
    if not touched:
        return []
    old = spark.read.parquet(path).where(F.col(partition).isin(touched))
    kept = old.join(changes.select(partition, *[k for k in key if k != partition]), list(dict.fromkeys([partition, *key])), "left_anti")
    stage = scratch_path(spark, "upsert")
    kept.unionByName(changes).write.partitionBy(partition).parquet(stage)
    fresh = spark.read.schema(spark.read.parquet(path).schema).parquet(stage)
    (fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path))
    return sorted(touched)
