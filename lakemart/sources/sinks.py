"""Writers: layer tables (staged replacement, partitions, buckets), CSV, JSON Lines.

Writes go to paths named by the caller (on a cluster: shared storage); a
written table is also how lineage is cut between layers.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions import quote_name
from lakemart.operators.joins import fits_broadcast

#: Versions of a published table that stay on disk: the one that the table
#: names, and the one before it for readers that are still at work.
KEPT_VERSIONS = 2


def ensure_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    """``schema`` may name its catalog too (``catalog.schema``)."""
    loc = f" LOCATION '{location}'" if location else ""
    named = ".".join(f"`{part}`" for part in schema.split("."))
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {named}{loc}")


def write_table(df: DataFrame, name: str, path: str | None = None, partition_by: list[str] | None = None,
                fmt: str = "parquet") -> None:
    """Replace table ``name`` (schema included), creating its schema if absent.

    With ``path`` the table is external at that location. Overwriting a table
    the same plan reads is refused by Spark, so each layer writes its own table.
    """
    spark = df.sparkSession
    if "." in name:
        ensure_schema(spark, name.rpartition(".")[0])
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter(F.col("col_name") == "Location").select("data_type").take(1)
    return rows[0][0]


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _point_at(spark: SparkSession, name: str, schema, location: str, partition_by: Sequence[str], fmt: str) -> None:
    """Make table ``name`` name the files at ``location``. With an unchanged
    schema this is one change of the catalog entry; a partitioned table is
    registered anew, since its entry also names each partition's folder."""
    if not partition_by and spark.catalog.tableExists(name) and spark.read.table(name).schema.simpleString() == schema.simpleString() \
            and not any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    else:
        columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
        parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # an external table: its files stay
        spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt}{parts} LOCATION '{location}'")
    if partition_by:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)


def publish_table(df: DataFrame, name: str, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Replace table ``name``, schema included, in two steps: the rows are written
    to a new version folder below ``path``, then the table is pointed at it.

    A write that fails leaves the table as it was, and a plan may read the very
    table that it replaces. One writer a table is assumed. Versions older than
    the last KEPT_VERSIONS are removed after the swap."""
    spark = df.sparkSession
    if "." in name:
        ensure_schema(spark, name.rpartition(".")[0])
    # Partition columns come last in a table of files.
    df = df.select(*map(quote_name, [*[c for c in df.columns if c not in partition_by], *partition_by]))
    where, files = _files(spark, path)
    number = max([0, *(int(f.getPath().getName().split("-")[1]) for f in files.listStatus(where))]) + 1 if files.exists(where) else 1
    version = f"{path.rstrip('/')}/version-{number:06d}-{uuid.uuid4().hex[:8]}"
    try:
        df.write.format(fmt).partitionBy(*partition_by).save(version)
    except Exception:
        files.delete(_files(spark, version)[0], True)
        raise
    _point_at(spark, name, df.schema, version, partition_by, fmt)
    for old in sorted(f.getPath().getName() for f in files.listStatus(where))[:-KEPT_VERSIONS]:
        files.delete(_files(spark, f"{path.rstrip('/')}/{old}")[0], True)


def replace_partitions(df: DataFrame, name: str, partition_by: Sequence[str], fmt: str = "parquet") -> None:
    """Replace the partitions of table ``name`` that ``df`` has rows of; all others
    stay. Spark stages the files and moves whole partitions at the commit, so a
    write that fails changes nothing."""
    spark = df.sparkSession
    columns = spark.read.table(name).columns
    (df.select(*map(quote_name, columns)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .format(fmt).partitionBy(*partition_by).save(table_location(spark, name)))
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)


def hottest_share(df: DataFrame, column: str) -> float:
    """Share of the rows that the most frequent value of ``column`` holds (two
    numbers reach the driver; the counts are partial aggregates)."""
    top, rows = df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.sum("n")).first()
    return top / rows if rows else 0.0


def write_bucketed(df: DataFrame, name: str, path: str, column: str, buckets: int, lookup: DataFrame | None = None,
                   columns: Sequence[Column] | None = None) -> DataFrame:
    """Write ``df`` as table ``name`` at ``path`` in ``buckets`` buckets of
    ``column``, sorted by it, one file a bucket, and read it back: joins and
    aggregates on the column with a table of as many buckets need no shuffle.

    ``lookup`` is joined on the column in the shuffle that makes the buckets, each
    task hashing its bucket of it; ``columns`` are then written, in this order."""
    dealt = df.repartition(buckets, column)
    if lookup is not None:
        dealt = dealt.join(F.broadcast(lookup) if fits_broadcast(lookup) else lookup.repartition(buckets, column).hint("shuffle_hash"), column)
    (dealt.select(*(columns or dealt.columns)).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, column).sortBy(column).saveAsTable(name))
    return df.sparkSession.read.table(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True,
              date_format: str = "yyyy-MM-dd") -> None:
    (df.write.mode("overwrite").option("header", header).option("sep", sep)
     .option("dateFormat", date_format).option("encoding", "UTF-8").csv(path))


def write_jsonl(df: DataFrame, path: str, keep_nulls: bool = True) -> None:
    """JSON Lines; NULL fields are written as explicit ``null``."""
    (df.write.mode("overwrite").option("ignoreNullFields", not keep_nulls)
     .option("dateFormat", "yyyy-MM-dd").json(path))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below the shared checkpoint folder and read
    it back: later jobs start from the files (computed once, lineage cut, a
    lost executor costs a re-read, not a recomputation)."""
    from lakemart.session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
