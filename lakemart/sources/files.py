"""Yearly source files: column contracts, register unions, hourly array replies."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakemart.functions import quote_name, variant_field
from lakemart.functions.variant import variant_path


class SchemaDriftError(RuntimeError):
    """A source file lacks columns the job requires."""


def normalised_header(df: DataFrame) -> dict[str, str]:
    """Trimmed lower-case header -> column name; names that clash fail."""
    names: dict[str, str] = {}
    for column in df.columns:
        if names.setdefault(column.strip().lower(), column) != column:
            raise SchemaDriftError(f"columns {names[column.strip().lower()]!r} and {column!r} differ in case or blanks only")
    return names


def read_csv_strings(spark: SparkSession, path: str | list[str], sep: str = ";") -> DataFrame:
    """Header CSV with every column as text (no type inference)."""
    return (spark.read.option("header", True).option("sep", sep).option("inferSchema", False)
            .option("encoding", "UTF-8").option("enforceSchema", False).csv(path))


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The files that Spark reads at a path (a listing, no data)."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.getFileStatus(where).isFile():
        return [path]
    found = []
    for status in files.listStatus(where):
        name = status.getPath().getName()
        if not name.startswith(("_", ".")):
            found += [status.getPath().toString()] if status.isFile() else data_files(spark, status.getPath().toString())
    return sorted(found)


def header_of(spark: SparkSession, file: str, sep: str) -> tuple[str, ...]:
    """The column names in a file's first line (packed files by their ending)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(file)
    stream = where.getFileSystem(conf).open(where)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(where)
        plain = codec.createInputStream(stream) if codec is not None else stream
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()
    return tuple(next(csv.reader([line.lstrip("\ufeff")], delimiter=sep))) if line else ()


def read_by_header(spark: SparkSession, path: str, required: Sequence[str], sep: str = ";") -> DataFrame:
    """The ``required`` columns of all CSV files at a path, each file read by its
    own header: files of one header are one scan, and the scans are unioned by
    name. Only first lines pass through the driver. A file without a required
    column raises :class:`SchemaDriftError` with its name; empty files are left out."""
    files = data_files(spark, path)
    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(lambda f: header_of(spark, f, sep), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, headers):
        missing = [c for c in required if c not in header]
        if missing and header:
            raise SchemaDriftError(f"{file}: missing columns {missing}")
        if header:
            groups.setdefault(header, []).append(file)
    scans = []
    for header, members in sorted(groups.items()):
        schema = StructType([StructField(c, StringType()) for c in header])
        cells = spark.read.schema(schema).csv(members, header=True, sep=sep, encoding="UTF-8", enforceSchema=False)
        scans.append(cells.select(*[quote_name(c) for c in required]))
    if not scans:
        return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in required]))
    return reduce(DataFrame.unionByName, scans)


def read_years(spark: SparkSession, paths: Mapping[int, str], required: Sequence[str], sep: str = ";",
               year_column: str = "source_year") -> DataFrame:
    """Per-year CSV sets reduced to ``required`` columns and unioned by name.

    Every file's header is checked before any data job runs; a missing column
    raises :class:`SchemaDriftError` naming the file and the columns. Files are
    read by their own headers, so a column order that differs cannot shift values.
    """
    if not paths:
        raise ValueError("no source years given")
    return reduce(DataFrame.unionByName, [
        read_by_header(spark, path, required, sep).withColumn(year_column, F.lit(year)) for year, path in sorted(paths.items())])


def register_union(frames: Mapping[int, DataFrame], columns: Mapping[str, Sequence[str]],
                   year_column: str = "register_year") -> DataFrame:
    """Yearly register tables tagged with their year and unioned.

    ``columns`` maps each output name to candidate source names, matched
    trimmed and case-insensitive per year; a year without a match raises
    :class:`SchemaDriftError`.
    """
    parts = []
    for year, df in sorted(frames.items(), reverse=True):
        header, cols = normalised_header(df), []
        for out_name, candidates in columns.items():
            known = [header[key] for key in (c.strip().lower() for c in candidates) if key in header]
            if not known:
                raise SchemaDriftError(f"register {year}: no column for {out_name} "
                                       f"(tried {list(candidates)}; have {df.columns})")
            cols.append(quote_name(known[0]).alias(out_name))
        parts.append(df.select(*cols, F.lit(year).alias(year_column)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: The arrays of a marine weather reply and their element types.
HOURLY_FIELDS = (("time", "string"), ("sea_surface_temperature", "double"), ("wave_height", "double"), ("ocean_current_velocity", "double"))


def open_replies(bronze: DataFrame, keep: Sequence[str] = (), fields: Sequence[tuple[str, str]] = HOURLY_FIELDS, payload: str = "payload") -> DataFrame:
    """Replies in Bronze (one JSON object a row) to one row per reading.

    The reply's ``hourly`` object holds parallel arrays. Each must be there and be
    as long as the first; else the job fails and says which one of which reply
    (padding would move later values to wrong hours). ``keep``: further fields of
    the reply, as text."""
    replies = bronze.select(*[variant_field(payload, k).alias(k) for k in keep], F.col(payload).alias("_reply"),
                            *[F.try_variant_get(payload, f"{variant_path('hourly')}.{f}", f"array<{kind}>").alias(f) for f, kind in fields])
    first = fields[0][0]
    for f, _ in fields:
        fault = F.concat(F.lit(f"hourly.{f} has "), F.coalesce(F.size(f).cast("string"), F.lit("no")), F.lit(" values, "), F.lit(f"{first} has "),
                         F.coalesce(F.size(first).cast("string"), F.lit("none")), F.lit(", in reply "), F.substring(F.to_json("_reply"), 1, 200))
        whole = F.col(f).isNotNull() & F.size(f).eqNullSafe(F.size(first))
        replies = replies.withColumn(f, F.when(whole, F.col(f)).otherwise(F.raise_error(fault)))
    zipped = replies.select(*keep, F.arrays_zip(*[f for f, _ in fields]).alias("_z"))
    return zipped.select(*keep, F.inline("_z"))


def explode_hourly(replies: DataFrame, struct_col: str = "hourly",
                   fields: Sequence[str] = ("time", "sea_surface_temperature", "wave_height",
                                            "ocean_current_velocity"),
                   keep: Sequence[str] = ()) -> DataFrame:
    """Parallel arrays of equal length to one row per position (``inline(arrays_zip)``)."""
    arrays = [F.col(f"{struct_col}.{f}").alias(f) for f in fields]
    zipped = replies.select(*keep, F.arrays_zip(*arrays).alias("_z"))
    return zipped.select(*keep, F.inline("_z"))
