"""Tables that appear as a whole: data in a folder of its own, then a manifest that names it."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession


class Conflict(Exception):
    """Another writer has published the version."""


def _folder(spark: SparkSession, target: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}/_versions")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _read(spark: SparkSession, store, path) -> dict | None:
    """A manifest, None while it is being written."""
    stream = store.open(path)
    try:
        text = bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
    try:
        return json.loads(text)
    except ValueError:
        return None


def newest(spark: SparkSession, target: str) -> dict | None:
    """The manifest of the last version: version, data and the facts published with it; None if there is none."""
    store, folder = _folder(spark, target)
    if not store.exists(folder):
        return None
    names = sorted((s.getPath().getName() for s in store.listStatus(folder) if s.getPath().getName().endswith(".json")), reverse=True)
    for name in names:
        found = _read(spark, store, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, name))
        if found is not None:
            return found
    return None


def publish(df: DataFrame, target: str, expect: int | None = None, **facts: object) -> int:
    """Make ``df`` the content of ``target``; returns the version.

    Readers see the version before until the manifest is there, and one broken off before
    that leaves only a folder that nothing names.  ``expect`` is the version that ``df`` was made from: if another has come
    since, or two writers publish at once, one of them gets :class:`Conflict` and its data do not count.  Earlier versions stay.
    """
    spark = df.sparkSession
    before = newest(spark, target)
    version = (before["version"] if before else 0) + 1
    if expect is not None and version != expect + 1:
        raise Conflict(f"version {version - 1} has been published since {expect}")
    data = f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{target.rstrip('/')}/{data}")
    store, folder = _folder(spark, target)
    store.mkdirs(folder)
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, f"{version:08d}.json")
    try:
        out = store.create(name, False)
    except Exception as e:
        if store.exists(name):
            raise Conflict(f"version {version} has been published by another writer") from e
        raise
    out.write(bytearray(json.dumps({"version": version, "data": data, **facts}).encode()))
    out.close()
    return version


def current(spark: SparkSession, target: str, schema: str | None = None) -> DataFrame:
    """The content of the last version.  If there is none: no rows of ``schema``, or an error without one."""
    found = newest(spark, target)
    if found is None:
        if schema is None:
            raise PySparkException(f"nothing has been published in {target}")
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{target.rstrip('/')}/{found['data']}")
