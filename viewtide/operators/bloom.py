"""A bitmap of keys, tested row by row where a large table is scanned.

Keys set two bits each in a bitmap of fixed size, which is aggregated in Spark and
reaches the scan as a scalar subquery. A row without its bits has none of the keys, so it
is dropped before any sort or exchange; the few others that pass are for a join to
refuse. The size does not grow with the keys: too many keys only make the test weaker.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 128 KB: about one other row in fifty passes with 80,000 keys.
BITS = 1 << 20
_WORD = 64


def _bits(on: Sequence[str], bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(seed), *on), F.lit(bits)) for seed in (1, 2)]


def _flag(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), (bit % _WORD).cast("int"))


def _bitmap(keys: DataFrame, on: Sequence[str], bits: int) -> Column:
    """All words of the bitmap in order, as an array. One row per word at most is
    collected in one place."""
    bit = F.col("bit")
    words = keys.select(F.explode(F.array(*_bits(on, bits))).alias("bit")).groupBy(
        F.floor(bit / _WORD).alias("id")).agg(F.bit_or(_flag(bit)).alias("word"))
    every = keys.sparkSession.range(bits // _WORD).join(words, "id", "left").select(
        F.struct("id", F.coalesce("word", F.lit(0).cast("bigint")).alias("word")).alias("w"))
    return every.agg(F.transform(F.sort_array(F.collect_list("w")), lambda w: w["word"]).alias(
        "words")).scalar()


def maybe_in(rows: DataFrame, keys: DataFrame, on: Sequence[str], bits: int = BITS) -> DataFrame:
    """The rows whose ``on`` may be among the keys; none that is gets lost."""
    words = _bitmap(keys, on, bits)
    for bit in _bits(on, bits):
        word = F.get(words, F.floor(bit / _WORD).cast("int"))
        rows = rows.filter(word.bitwiseAND(_flag(bit)) != 0)
    return rows
