"""Balanced label propagation: shards of even size that cut few links.

Documents of equal text are linked. Every document starts in a shard drawn from
its id. Copies of one text that are in the same shard are one vertex with a
weight, so a text with very many copies is a few rows. In every round each group
adds up the weights per shard, its vertices ask for the shard with most of the
group that still has room, and a shard admits requests up to its quota. Groups
without links stay where they are; they are the ballast with which shards are
evened out at the end.

The law is ``rows``: shards differ by at most one document. After the rounds the
excess of a shard leaves in a fixed order, unlinked documents first, then small
groups, and fills the shards that lack documents. A group is only cut if it does
not fit or stands at such an edge.

Cases: null texts count as empty, and all empty texts are one group. Repeated
rows are placed one by one. A null id is drawn like any other. An empty table
gives no rows; fewer documents than shards leave shards empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide.llm.graph import stored
from viewtide.operators.ranking import with_position

SHARDS = 8
ROUNDS = 12
PARTS = 1_000_000
TEXT = ("text_hash", "text_crc32")


def measured(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Rows ``doc_id, size, text_crc32, text_hash, start``."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("text_hash"),
        F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("start"))


def vertices(rows: DataFrame) -> DataFrame:
    """Copies of one text with one starting shard, of texts with several copies."""
    parts = rows.groupBy(*TEXT, "start").agg(F.count("*").alias("n"))
    linked = (parts.groupBy(*TEXT).agg(F.sum("n").alias("group_size"))
              .filter("group_size > 1"))
    return parts.join(linked, list(TEXT)).withColumn("shard", F.col("start"))


def _by_shard(frame: DataFrame, key: str, shards: int) -> list[int]:
    """Rows per shard: ``shards`` numbers."""
    found = {row[0]: row[1] for row in frame.groupBy(key).agg(F.sum("n")).collect()}
    return [found.get(shard, 0) for shard in range(shards)]


def _pick(values: list, shard: str) -> Column:
    return F.element_at(F.array(*[F.lit(value) for value in values]), F.col(shard) + 1)


def propagate(state: DataFrame, total: int, shards: int = SHARDS,
              rounds: int = ROUNDS) -> DataFrame:
    """Moves vertices towards the shard of most of their group.

    Each round is a partially aggregated sum per group and shard and a join back
    to the vertices. The driver gets one number per shard, twice a round. A
    quota is kept by admitting a fraction of the requests, chosen by hash; whole
    groups where they are small, single vertices where they are large.
    """
    state = stored(state, "shards")
    capacity = total / shards
    for round_ in range(rounds):
        room = [max(0.0, capacity - load) for load in _by_shard(state, "shard", shards)]
        votes = state.groupBy(*TEXT, "shard").agg(F.sum("n").alias("votes"))
        # A shard with hardly any room is no target, or the group would wait for it.
        roomy = [shard for shard, space in enumerate(room) if space > 0.02 * capacity]
        best = votes.groupBy(*TEXT).agg(F.count("*").alias("spread"), F.max(F.when(
            F.col("shard").isin(roomy), F.struct(
                "votes", F.xxhash64(*TEXT, "shard").alias("tie"), "shard"))).alias("best"))
        own = state.join(votes, [*TEXT, "shard"]).join(best, list(TEXT))
        small = F.col("group_size") <= 0.02 * capacity
        # Of equal shards one is drawn, but never a full one before an open one.
        tie = F.when(F.col("shard").isin(roomy), F.xxhash64(*TEXT, "shard")).otherwise(
            F.lit(-(1 << 63)))
        wants = (F.col("shard") != F.col("best.shard")) & (
            F.struct("votes", tie.alias("tie")) < F.struct("best.votes", "best.tie"))
        target = F.when(wants, F.col("best.shard"))
        if roomy:
            # A small group that is cut over full shards meets in a third one.
            stuck = small & F.col("best").isNull() & (F.col("spread") > 1)
            target = target.when(stuck, F.element_at(
                F.array(*map(F.lit, roomy)),
                F.pmod(F.xxhash64(*TEXT), F.lit(len(roomy))).cast("int") + 1))
        asked = stored(own.select(*state.columns, target.cast("int").alias("target")), "requests")
        demand = _by_shard(asked.filter("target IS NOT NULL"), "target", shards)
        if not any(demand):
            break
        admitted = _pick([min(PARTS, int(PARTS * space / max(1, want)))
                          for space, want in zip(room, demand, strict=True)], "target")
        draw = F.pmod(F.xxhash64(*TEXT, F.when(~small, F.col("start")), F.lit(round_)),
                      F.lit(PARTS))
        state = stored(asked.select(
            *TEXT, "start", "n", "group_size",
            F.when(F.col("target").isNotNull() & (draw < admitted), F.col("target"))
            .otherwise(F.col("shard")).alias("shard")), "shards")
    return state


def _levelled(rows: DataFrame, shards: int) -> DataFrame:
    """Moves the excess of every shard to the shards that lack rows; adds slots.

    Rows are numbered in one distributed order; the rest is arithmetic with one
    number per shard.
    """
    placed = with_position(rows.orderBy(
        "shard", "group_size", "text_hash", "text_crc32", "doc_id"), "_position")
    loads = _by_shard(placed.select("shard", F.lit(1).alias("n")), "shard", shards)
    total = sum(loads)
    quota = [total // shards + (shard < total % shards) for shard in range(shards)]
    excess = [max(0, load - fair) for load, fair in zip(loads, quota, strict=True)]
    lack = [max(0, fair - load) for load, fair in zip(loads, quota, strict=True)]
    before = [sum(loads[:shard]) for shard in range(shards)]
    left_before = [sum(excess[:shard]) for shard in range(shards)]
    place = F.col("_position") - 1 - _pick(before, "shard")
    leaving = place < _pick(excess, "shard")
    number = place + _pick(left_before, "shard")
    target, slot, reached = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    for shard in range(shards):
        inside = (number >= reached) & (number < reached + lack[shard])
        target = F.when(inside, F.lit(shard)).otherwise(target)
        slot = F.when(inside, number - reached + loads[shard]).otherwise(slot)
        reached += lack[shard]
    return placed.select(
        *rows.columns, F.when(leaving, target).otherwise(F.col("shard")).alias("_shard"),
        F.when(leaving, slot).otherwise(place - _pick(excess, "shard")).cast("long").alias("slot")
    ).drop("shard").withColumnRenamed("_shard", "shard")


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Rows ``doc_id, size, text_crc32, law, shard, slot, group_size``."""
    rows = stored(measured(docs, shards), "rows")
    total = rows.count()
    state = propagate(vertices(rows), total, shards, rounds)
    joined = rows.join(state.select(*TEXT, "start", "shard", "group_size"),
                       [*TEXT, "start"], "left")
    chosen = joined.select(
        "doc_id", "size", *TEXT, F.coalesce("shard", "start").alias("shard"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"))
    return _levelled(chosen, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", "group_size")
