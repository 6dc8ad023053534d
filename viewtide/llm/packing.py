"""Packing by minimum bin slack.

A document's tokens are cut into whole windows and one remainder. Remainders
are packed by length: a subset-sum table, kept as a bitset per length, tells
which sums the remaining lengths can reach; the sum closest to the window is
traced back to the number of pieces of each length, and that pattern is used as
often as the remaining pieces allow. The plan depends only on the number of
pieces per length, so it is as small for a billion pieces as for a thousand.
Pieces then find their place by their rank among the pieces of their length.

Cases: an empty or null text has only its end id and is packed like any other.
Equal rows, also of equal id, are packed one by one. An empty table gives no
pieces. Other columns are left out, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.llm.graph import stored
from viewtide.llm.tokens import encoder, widened
from viewtide.operators.ranking import with_position

WINDOW = 2048
BATCH = 256

PIECE = "doc_id LONG, start LONG, length LONG, doc_tokens LONG, ids BINARY"
PLAN = "length LONG, first LONG, last LONG, each LONG, sequence LONG, place LONG, size LONG"


def token_pieces(docs: DataFrame, path: str, end_id: int, window: int = WINDOW) -> DataFrame:
    """Pieces of every document: whole windows, then what remains.

    ``doc_id, start, length, doc_tokens, ids``, ids as little-endian unsigned
    32-bit integers. Every document has at least its end id.
    """
    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = encoder(path)
        end = np.array([end_id], "<u4").tobytes()
        for frame in frames:
            for at in range(0, len(frame), BATCH):
                part = frame.iloc[at:at + BATCH]
                rows = []
                for doc_id, ids in zip(part["doc_id"], code.encode(part["text"].tolist()),
                                       strict=True):
                    data = widened(ids, code.dtype) + end
                    total = len(data) // 4
                    rows += [(doc_id, start, min(window, total - start), total,
                              data[4 * start:4 * (start + window)])
                             for start in range(0, total, window)]
                yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "doc_tokens", "ids"]
                                   ).astype({"doc_id": "Int64"})

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(
        cut, PIECE)


@dataclass(frozen=True)
class Pattern:
    """Pieces per length in one sequence, and how many sequences follow it."""

    counts: tuple[tuple[int, int], ...]
    times: int


def closest_sum(available: Mapping[int, int], capacity: int) -> dict[int, int]:
    """Pieces per length whose sum is the largest within ``capacity``.

    Bit ``s`` of a bitset says that the sum ``s`` can be reached. Multiples of a
    length enter as 1, 2, 4, ... pieces. Long pieces come first, and the table
    ends as soon as the capacity itself is reached.
    """
    mask = (1 << (capacity + 1)) - 1
    steps: list[tuple[int, int, int]] = []
    reach = 1
    for length in sorted((x for x in available if x <= capacity), reverse=True):
        left, lot = min(available[length], capacity // length), 1
        while left and not reach >> capacity & 1:
            take = min(lot, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left -= take
            lot *= 2
        if reach >> capacity & 1:
            break
    total = reach.bit_length() - 1
    counts: dict[int, int] = {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            counts[length] = counts.get(length, 0) + take
            total -= length * take
    return counts


def minimum_slack(pieces: Mapping[int, int], window: int = WINDOW) -> list[Pattern]:
    """Patterns that use up all pieces, given their number per length.

    Every pattern holds the longest piece that is left, so each round uses up
    some length or all copies that fit; the number of patterns is bounded by
    the window, not by the number of pieces.
    """
    left = {length: count for length, count in pieces.items() if count}
    plan = []
    while left:
        longest = max(left)
        left[longest] -= 1
        counts = closest_sum({x: n for x, n in left.items() if n}, window - longest)
        left[longest] += 1
        counts[longest] = counts.get(longest, 0) + 1
        times = min(left[length] // count for length, count in counts.items())
        for length, count in counts.items():
            left[length] -= count * times
            if not left[length]:
                del left[length]
        plan.append(Pattern(tuple(sorted(counts.items(), reverse=True)), times))
    return plan


def plan_rows(plan: list[Pattern]) -> list[tuple[int, ...]]:
    """One row per pattern and length: ranks it takes and where it puts them."""
    rows = []
    used: dict[int, int] = {}
    sequence = 0
    for pattern in plan:
        place, size = 0, sum(length * count for length, count in pattern.counts)
        for length, count in pattern.counts:
            first = used.get(length, 0)
            used[length] = first + count * pattern.times
            rows.append((length, first, used[length], count, sequence, place, size))
            place += length * count
        sequence += pattern.times
    return rows


def padded(size, window: int = WINDOW):
    """Length of a sequence in memory: the window, or ``size`` at a power of two."""
    return F.when(F.expr("(size & (size - 1)) = 0"), size).otherwise(F.lit(window))


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Adds ``sequence_id, offset, sequence_size, padded_size`` to pieces.

    ``pieces`` needs ``length`` (1 to ``window``), ``doc_id`` and ``start``. The
    rows are sorted by length and written once to the checkpoint folder. What
    the driver gets is one count per length, at most ``window`` rows; the plan
    that is broadcast has a few rows per length for the same reason.
    """
    spark = pieces.sparkSession
    # Stored first: sorting by ranges reads its input twice, and encoding is dear.
    placed = with_position(
        stored(pieces, "pieces").orderBy("length", "doc_id", "start"), "_position")
    sizes = {row["length"]: row["n"] for row in
             placed.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = plan_rows(minimum_slack(sizes, window))
    before, total = {}, 0
    for length in sorted(sizes):
        before[length] = total
        total += sizes[length]
    plan = spark.createDataFrame(
        [(*row, before[row[0]]) for row in rows], PLAN + ", before LONG")
    rank = F.col("_position") - 1 - F.col("before")
    joined = placed.join(
        F.broadcast(plan.withColumnRenamed("length", "_length")),
        (F.col("length") == F.col("_length")) & (rank >= F.col("first")) & (rank < F.col("last")))
    nth = rank - F.col("first")
    return joined.select(
        *[F.col(name) for name in pieces.columns],
        (F.col("sequence") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("place") + (nth % F.col("each")) * F.col("length")).alias("offset"),
        F.col("size").alias("sequence_size"),
        padded(F.col("size"), window).alias("padded_size"))


def pack_documents(docs: DataFrame, path: str, end_id: int, window: int = WINDOW) -> DataFrame:
    """Documents cut and packed; the ids of a piece stay with it in ``ids``."""
    return pack(token_pieces(docs, path, end_id, window), window)
