"""Writers of datasets and reports."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

DATASET = ("accounts", "videos", "video_metrics", "comments")
POINTER = "_current"


def _save(df: DataFrame, path: str, fmt: str) -> None:
    if fmt == "csv":
        df.write.option("header", True).csv(path)
    else:
        df.write.format(fmt).save(path)


def current_version(spark: SparkSession, folder: str) -> str | None:
    """Folder of the tables that the last complete refresh wrote; None before the first one."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{POINTER}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    with_ = fs.open(path)
    try:
        return f"{folder}/{with_.readUTF()}"
    finally:
        with_.close()


def switch_version(spark: SparkSession, folder: str, version: str) -> None:
    """Write the pointer beside its place and put it there in one step."""
    jvm = spark._jvm
    conf, path = spark._jsc.hadoopConfiguration(), jvm.org.apache.hadoop.fs.Path(f"{folder}/{POINTER}")
    beside = jvm.org.apache.hadoop.fs.Path(f"{folder}/{POINTER}-{version}")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), conf)
    out = path.getFileSystem(conf).create(beside, True)
    try:
        out.writeUTF(version)
    finally:
        out.close()
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(beside, path, over)


def write_dataset(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> str:
    """All tables into a new version folder, then one pointer is switched to it; returns the folder.

    Readers use ``read_dataset``. Until the last table is written they see the tables of the version before; a
    failure leaves these as they are, and a table may be read while it is replaced. Old versions stay until removed.
    """
    spark, version = next(iter(tables.values())).sparkSession, f"v-{uuid.uuid4().hex}"
    for name, df in tables.items():
        _save(df, f"{folder}/{version}/{name}", fmt)
    switch_version(spark, folder, version)
    return f"{folder}/{version}"


def read_dataset(spark: SparkSession, folder: str, name: str, fmt: str = "parquet") -> DataFrame:
    """A table of the current version."""
    version = current_version(spark, folder)
    if version is None:
        raise FileNotFoundError(f"no complete dataset in {folder}")
    return spark.read.csv(f"{version}/{name}", header=True) if fmt == "csv" else spark.read.format(fmt).load(f"{version}/{name}")


def write_pool(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> str:
    """The pool under ``valid_*`` and under the standard names, in one version.

    The pool is computed once: the second copy is read from the first.
    """
    spark, version = next(iter(tables.values())).sparkSession, f"v-{uuid.uuid4().hex}"
    for name, df in tables.items():
        first = f"{folder}/{version}/valid_{name}"
        _save(df, first, fmt)
        read = spark.read.schema(df.schema)
        _save(read.csv(first, header=True) if fmt == "csv" else read.format(fmt).load(first), f"{folder}/{version}/{name}", fmt)
    switch_version(spark, folder, version)
    return f"{folder}/{version}"


def write_report(df: DataFrame, path: str) -> None:
    """A report table as JSON lines. Reports are small, so one file is written per partition that has rows."""
    df.write.mode("overwrite").json(path)
