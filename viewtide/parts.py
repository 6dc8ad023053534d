"""Tables made of named parts that are replaced one by one and published at once.

A table folder holds ``data/<version>`` with one folder per part written in that
version, ``manifest/<version>`` with the folder of every current part, and
``published`` with the numbers of the finished versions. A load writes only the parts
it changes; for all others the new manifest points at the folders written before.
A version exists when its number is recorded, which is the last step of a load: a
reader sees the table before or after a load, never between, and a load that failed
half-way can simply be repeated. There is one writer at a time.

The manifest has one row per part, so the number of parts has to be chosen with care:
it is what the driver reads.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_PUBLISHED = "version INT, parts INT"
_MANIFEST = "part STRING, folder STRING"
_PART = "_part"


def _rows(spark: SparkSession, path: str, schema: str) -> list:
    try:
        return spark.read.schema(schema).parquet(path).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def current_version(spark: SparkSession, path: str) -> int | None:
    """Number of the version that readers see, ``None`` before the first load."""
    return max((row["version"] for row in _rows(spark, f"{path}/published", _PUBLISHED)),
               default=None)


@dataclass(frozen=True)
class State:
    """A version of a table: its number, ``None`` before the first load, and the folder
    of every part, relative to the table."""

    version: int | None
    folders: dict[str, str]


def state_of(spark: SparkSession, path: str, version: int | None = None) -> State:
    """The current version, or a given one."""
    version = current_version(spark, path) if version is None else version
    if version is None:
        return State(None, {})
    return State(version, {row["part"]: row["folder"] for row in _rows(
        spark, f"{path}/manifest/{version:06d}", _MANIFEST)})


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict[str, str]:
    """Folder of every part; of the current version by default."""
    return state_of(spark, path, version).folders


def read_parts(spark: SparkSession, path: str, schema, parts: Iterable[str] | None = None,
               version: int | None = None, state: State | None = None) -> DataFrame:
    """Rows of the given parts, of all by default. Only their folders are opened; parts
    that the table does not have are empty."""
    folders = (state or state_of(spark, path, version)).folders
    names = folders if parts is None else [name for name in parts if name in folders]
    if not names:
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).option("recursiveFileLookup", True)
            .parquet(*[f"{path}/{folders[name]}" for name in names]))


def replace_parts(table: DataFrame, part: Column | str, path: str,
                  cleared: Iterable[str] = (), arranged: bool = False,
                  sort: Iterable[str] = (), state: State | None = None) -> list[str]:
    """Writes the parts present in ``table`` and publishes them with the others.

    ``part`` names the part of a row, in characters that folders allow. Parts in
    ``cleared`` that ``table`` does not hold are dropped. Rows are rebalanced by part,
    so a part that holds much more than the others has several files; ``arranged``
    tells that the rows already lie together by part. ``state`` is the current version
    where the caller has read it. Returns the parts written.
    """
    spark = table.sparkSession
    state = state or state_of(spark, path)
    before = state.folders
    version = 0 if state.version is None else state.version + 1
    folder = f"data/{version:06d}"
    rows = table.withColumn(_PART, F.col(part) if isinstance(part, str) else part)
    if not arranged:
        rows = rows.hint("rebalance", F.col(_PART))
    rows = rows.sortWithinPartitions(_PART, *sort)
    # What an unfinished load left under this number is replaced.
    rows.write.mode("overwrite").partitionBy(_PART).parquet(f"{path}/{folder}")
    written = _parts_in(spark, f"{path}/{folder}")
    current = {name: place for name, place in before.items() if name not in set(cleared)}
    current |= {name: f"{folder}/{_PART}={name}" for name in written}
    publish(spark, path, version, current)
    return written


def publish(spark: SparkSession, path: str, version: int, folders: dict[str, str]) -> None:
    """Records a manifest and then its version."""
    (spark.createDataFrame(sorted(folders.items()), _MANIFEST).coalesce(1)
     .write.mode("overwrite").parquet(f"{path}/manifest/{version:06d}"))
    (spark.createDataFrame([(version, len(folders))], _PUBLISHED).coalesce(1)
     .write.mode("append").parquet(f"{path}/published"))


def _file_system(spark: SparkSession, path: str):
    """The store of a path, through Spark's own configuration: any scheme it can write."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _parts_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the part folders; listed, so no file is opened."""
    store, place = _file_system(spark, path)
    prefix = f"{_PART}="
    names = [status.getPath().getName() for status in store.listStatus(place)]
    return sorted(name[len(prefix):] for name in names if name.startswith(prefix))


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Deletes part folders that none of the last ``keep`` versions uses; returns them.

    Readers of an older version lose it, so keep as many as readers may still hold.
    """
    current = current_version(spark, path)
    if current is None:
        return []
    used = {place for version in range(max(0, current - keep + 1), current + 1)
            for place in manifest(spark, path, version).values()}
    dropped = []
    for version in range(current + 1):
        folder = f"data/{version:06d}"
        store, place = _file_system(spark, f"{path}/{folder}")
        if not store.exists(place):
            continue
        for name in _parts_in(spark, f"{path}/{folder}"):
            part = f"{folder}/{_PART}={name}"
            if part not in used:
                store.delete(_file_system(spark, f"{path}/{part}")[1], True)
                dropped.append(part)
    return dropped
