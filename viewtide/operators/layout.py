"""Physical choices left to the user."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from viewtide.operators.rollup import PAGE

# Names of the storage levels a run can ask for.
STORAGE_LEVELS = {
    "MEMDISK": StorageLevel.MEMORY_AND_DISK,
    "DISK": StorageLevel.DISK_ONLY,
}


def partition_by_key(facts: DataFrame, partitions: int,
                     key: tuple[str, ...] = ("day", *PAGE)) -> DataFrame:
    """Facts hashed by key into a chosen number of partitions.

    Meant for summed facts, where a key has one row.
    """
    return facts.repartition(partitions, *key)


def persist_level(facts: DataFrame, level: str = "MEMDISK") -> DataFrame:
    """Keeps a table that several results read, at ``MEMDISK`` or ``DISK``."""
    return facts.persist(STORAGE_LEVELS[level.upper()])
