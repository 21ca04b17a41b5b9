"""Writers: records, shards of lines, keyed records, word vectors, metrics."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.lineage import cut


def write_records(df: DataFrame, path: str, format: str = "parquet") -> None:
    """Parquet (the default), json, or text with one rendered record a line."""
    if format == "text":
        df.select(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns))).alias("value")).write.mode("overwrite").text(path)
    else:
        df.write.mode("overwrite").format(format).save(path)


def write_metrics(path: str, metrics: dict[str, DataFrame], counts: dict[str, dict] | None = None) -> str:
    """One JSON text of all metrics' rows, a few each, and of counts of records, written through Spark; also returned."""
    spark = next(iter(metrics.values())).sparkSession
    rows = {name: [json.loads(r) for r in df.toJSON().collect()] for name, df in metrics.items()}
    text = json.dumps(rows | ({"records": counts} if counts else {}), sort_keys=True)
    spark.range(1).select(F.lit(text).alias("value")).write.mode("overwrite").text(path)
    return text


def shard_lines(lines: DataFrame, path: str, shards: int = 24, compression: str = "gzip") -> None:
    """Lines dealt evenly to a number of files; bytes stay as they are."""
    lines.select("value").repartition(shards).write.mode("overwrite").option("lineSep", "\n").option("compression", compression).text(path)


def sized_shards(lines: DataFrame, order: list[str], chars: int = 500_000_000, buckets: int = 1024) -> DataFrame:
    """The lines with ``shard``: numbers that grow by one for every ``chars`` characters in the given order.

    Sums are taken within ranges of the order, then over the ranges, so no task sees all lines.
    """
    spark = lines.sparkSession
    ranged = lines.withColumn("__size", F.length("value").cast("long")).repartitionByRange(min(buckets, max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))), *order).withColumn("__range", F.spark_partition_id())
    ranged = cut(ranged)  # ranges are sampled; everything below must see the same ones
    sums = ranged.groupBy("__range").agg(F.sum("__size").alias("s"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = sums.select(F.col("__range").alias("r"), F.coalesce(F.sum("s").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    at: Column = F.sum("__size").over(inside) - F.col("__size")
    return ranged.withColumn("__at", at).join(F.broadcast(starts), F.col("__range") == F.col("r")).withColumn("shard", F.floor((F.col("__at") + F.col("start")) / chars)).drop("__size", "__range", "__at", "r", "start")


def shard_name(pattern: str, k: int) -> str:
    """The name of a shard: its number, in five digits, for ``{}``, or before the suffix."""
    if "{}" not in pattern:
        folder, slash, name = pattern.rpartition("/")
        stem, dot, suffix = name.partition(".")
        pattern = f"{folder}{slash}{stem}-{{}}{dot}{suffix}"
    return pattern.replace("{}", f"{k:05d}")


def write_sized_shards(lines: DataFrame, order: list[str], pattern: str, chars: int = 500_000_000, max_lines: int | None = None) -> list[str]:
    """One gz file a shard, named by ``shard_name``; the files' names. max_lines: of the first ones in the order.

    Lines of a shard meet in one task, which writes them in order.
    """
    spark = lines.sparkSession
    if max_lines is not None:
        lines = lines.orderBy(*order).limit(max_lines)
    folder = f"{pattern.rpartition('/')[0] or '.'}/_shards-{uuid.uuid4().hex}"
    rows = sized_shards(lines, order, chars)
    rows.repartition("shard").sortWithinPartitions("shard", *order).select("shard", "value").write.partitionBy("shard").option("lineSep", "\n").option("compression", "gzip").text(folder)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for f in fs.globStatus(path(f"{folder}/shard=*/part-*")):
        name = shard_name(pattern, int(f.getPath().getParent().getName().partition("=")[2]))
        fs.delete(path(name), False)
        fs.rename(f.getPath(), path(name))
        out.append(name)
    fs.delete(path(folder), True)
    return sorted(out)


def keyed(df: DataFrame, kind: str, id_field: str | None = None, stringify: bool = False, parent: str | None = None) -> DataFrame:
    """Records of a key-value store: kind, key (the id, or a SHA-1 of the record's JSON), parent (a key's text), properties (JSON)."""
    record = F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)))
    key = F.col(id_field).cast("string") if id_field else F.sha1(record)
    return df.select(F.lit(kind).alias("kind"), key.alias("key"), F.lit(parent).cast("string").alias("parent"), (F.to_json(F.struct(record.alias("content"))) if stringify else record).alias("properties"))


# A store is a folder with a folder for each version and a small file that names the current one.
# A writer that dies leaves the current version as it was.


def _current(spark: SparkSession, path: str) -> int:
    """The number of the current version, 0 for a store that isn't there yet."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/current-*"))
    return max((int(f.getPath().getName().partition("-")[2]) for f in found or []), default=0)


def _publish(spark: SparkSession, path: str, rows: DataFrame, version: int) -> None:
    jvm = spark.sparkContext._jvm
    to = lambda name: jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    rows.write.mode("overwrite").parquet(f"{path}/version-{version}")
    fs = to("x").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.createNewFile(to(f"current-{version}")):
        raise RuntimeError(f"another writer has made version {version} of {path}")
    for old in (version - 2,):  # readers of the last version go on
        fs.delete(to(f"current-{old}"), False)
        fs.delete(to(f"version-{old}"), True)


def upsert(spark: SparkSession, path: str, rows: DataFrame, order: str | None = None) -> None:
    """Write keyed records into a store; a record replaces one of its kind and key.

    order: a column of rows; of several new records of a key the one with the greatest
    is kept. Without it there may be one a key only.
    """
    if order is None and rows.groupBy("kind", "key").count().filter("count > 1").limit(1).count():
        raise ValueError("several records of a key: name a column that orders them")
    columns = ["kind", "key", "parent", "properties"]
    newest = rows.groupBy("kind", "key").agg(F.max_by(F.struct("parent", "properties"), F.col(order) if order else F.lit(0)).alias("r")).select("kind", "key", "r.*")
    version = _current(spark, path)
    if version:
        newest = spark.read.parquet(f"{path}/version-{version}").join(newest, ["kind", "key"], "left_anti").select(*columns).unionByName(newest.select(*columns))
    _publish(spark, path, newest.select(*columns), version + 1)


def delete_keys(spark: SparkSession, path: str, keys: DataFrame) -> None:
    """Take records out of a store; keys: kind, key."""
    version = _current(spark, path)
    if version:
        _publish(spark, path, spark.read.parquet(f"{path}/version-{version}").join(keys.select("kind", "key"), ["kind", "key"], "left_anti"), version + 1)


def query_store(spark: SparkSession, path: str, kind: str, limit: int | None = None, parent: str | None = None) -> DataFrame:
    """Records of a kind, and of a parent; with a limit the first ones by key."""
    rows = spark.read.parquet(f"{path}/version-{_current(spark, path)}").filter(F.col("kind") == kind)
    if parent is not None:
        rows = rows.filter(F.col("parent") == parent)
    return rows.orderBy("key").limit(limit) if limit is not None else rows


def write_intermediates(path: str, **tables: DataFrame) -> None:
    """Tables between the steps of a plan, as text, to look at: a folder each."""
    for name, df in tables.items():
        write_records(df, f"{path.rstrip('/')}/{name}", "text")


def vector_lines(vectors: DataFrame) -> DataFrame:
    """Lines of a text of word vectors, with ``doc_count`` of the words: pos, value.

    Names lose tabs and blanks; entities get their prefix; numbers have four decimals.
    The order is that of doc_count, falling, then the name; pos is 0 for the header.
    """
    name = F.replace(F.replace("name", F.lit("\t"), F.lit(" ")), F.lit(" "), F.lit("_"))
    name = F.when(F.col("is_entity"), F.concat(F.lit("ENTITY/"), name)).otherwise(name)
    line = F.concat_ws(" ", name, F.array_join(F.transform("vector", lambda x: F.format_string("%.4f", x)), " "))
    body = vectors.select(F.lit(1).alias("pos"), F.col("doc_count"), F.col("name"), line.alias("value"))
    head = vectors.agg(F.concat_ws(" ", F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).alias("value")).select(F.lit(0).alias("pos"), F.lit(None).cast("long").alias("doc_count"), F.lit(None).cast("string").alias("name"), "value")
    return head.unionByName(body).orderBy("pos", F.col("doc_count").desc(), "name").select("pos", "value")


def write_vectors(vectors: DataFrame, path: str) -> None:
    vector_lines(vectors).select("value").write.mode("overwrite").option("lineSep", "\n").text(path)
