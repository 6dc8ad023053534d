"""Near-duplicates by SimHash with deletion-variant signatures.

A fingerprint of 64 bits is cut into so few segments that two fingerprints
within the radius agree on one segment up to a single bit. Each segment is
indexed under its one-wildcard variants: the segment with one bit left out, and
the place of that bit. Two segments that differ in at most one bit share a
variant, so an equality join on variants finds every pair within the radius;
each candidate is then verified on all 64 bits.

Equal fingerprints are one row before anything is joined, however many
documents carry them. A variant that few fingerprints share is joined with
itself. The fingerprints of a crowded variant are dealt into blocks, every two
blocks meet in one group of bounded size, and that group returns only the links
of a spanning forest: no link between components is lost and no square of the
crowd is written.

Cases: null and wordless texts have fingerprint zero and are linked like any
other. Repeated rows are kept, with equal results. A null id is carried along and
never names a component unless the component has no other id.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide.llm.graph import stored, components

# The seed and the word pattern of the fingerprint.
SEED = 42
BITS = 64
SHINGLE = 4
RADIUS = 4
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_UPPER = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}

# Fingerprints that share a variant: up to CROWD are joined directly, more are
# dealt into blocks of about BLOCK.
CROWD = 64
BLOCK = 512


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of all shingles of one whole text, in order; none for a wordless text."""
    import xxhash
    words = _WORD.findall(text.translate(_UPPER)) if text else []
    if not words:
        return np.empty(0, np.uint64)
    joined = " ".join(words).encode()
    sizes = np.fromiter((len(word.encode()) for word in words), np.int64, len(words))
    if len(joined) == len(words) - 1 + sum(map(len, words)):
        sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    last = ends[min(shingle, len(words)) - 1:]
    first = np.concatenate([[0], ends[:-1] + 1])[:len(last)]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in
                        zip(first.tolist(), last.tolist(), strict=True)), np.uint64, len(last))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one whole text as a signed 64-bit integer.

    Bit sums are taken over slices of the shingles, so a long text needs no
    more memory than its words and hashes.
    """
    hashes = shingle_hashes(text, shingle)
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        octets = hashes[at:at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text",
                 output: str = "fingerprint") -> DataFrame:
    """The table with the fingerprint of every text as a LONG."""
    @F.pandas_udf("long")
    def marked(texts: pd.Series) -> pd.Series:
        return texts.map(lambda value: fingerprint(value, shingle)).astype("int64")
    return docs.withColumn(output, marked(F.coalesce(F.col(text), F.lit(""))))


def hexadecimal(value: Column) -> Column:
    """16 lowercase hexadecimal digits of a LONG."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


@dataclass(frozen=True)
class Segment:
    shift: int
    width: int


def segments(radius: int) -> list[Segment]:
    """The fewest segments of which one differs by at most one bit."""
    count = radius // 2 + 1
    bounds = [round(i * BITS / count) for i in range(count + 1)]
    return [Segment(a, b - a) for a, b in zip(bounds, bounds[1:], strict=False)]


def variants(value: Column, radius: int) -> Column:
    """Array of one-wildcard segment variants, each as ``slot`` and ``rest``.

    The slot names the segment and the wildcard, the rest is the segment with
    that bit cleared.
    """
    keys = []
    for segment in segments(radius):
        mask = (1 << segment.width) - 1
        part = F.shiftrightunsigned(value, segment.shift).bitwiseAND(F.lit(mask))
        for bit in range(segment.width):
            slot = segment.shift + bit
            keys.append(F.lit(slot << 48).bitwiseOR(part.bitwiseAND(F.lit(mask & ~(1 << bit)))))
    return F.array(*keys)


def _differing(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def forest(left: np.ndarray, right: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of two blocks of fingerprints.

    Linked pairs are all those within the radius between the blocks (or inside
    one block, given twice); the forest connects exactly what they connect.
    """
    values, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    parent = list(range(len(values)))

    def root(node: int) -> int:
        while parent[node] != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    links = []
    to = at[len(left):]
    for node, value in zip(at[:len(left)].tolist(), left, strict=True):
        near = to[np.bitwise_count((right ^ value).view(np.uint64)) <= radius]
        for other in near.tolist():
            a, b = root(node), root(other)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((int(values[node]), int(values[other])))
    return links


def links(marks: DataFrame, radius: int = RADIUS, crowd: int = CROWD,
          block: int = BLOCK) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints that connect all pairs within
    the radius. ``marks`` has one row per fingerprint, in column ``f``.

    Spark sizes the index as if each fingerprint had one row, not one per variant. It would
    broadcast it, so the joins on it are merged whatever the size, and it would make all of
    it in a few tasks, so the fingerprints are dealt out first.
    """
    parts = int(marks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = marks.repartition(parts, "f").select("f", F.explode(variants(F.col("f"), radius)).alias("key"))
    crowded = stored(index.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > crowd),
                     "crowded")
    few = index.join(crowded, "key", "left_anti")
    left, right = (few.select("key", F.col("f").alias(name)) for name in ("a", "b"))
    pairs = left.join(right.hint("merge"), (left["key"] == right["key"]) & (F.col("a") < F.col("b"))
                      & (_differing("a", "b") <= radius)).select("a", "b").distinct()

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        values, second = group["f"].to_numpy("i8"), group["second"].to_numpy(bool)
        return pd.DataFrame(forest(values[~second], values[second], radius),
                            columns=["a", "b"], dtype="i8")

    many = (index.join(crowded.hint("merge"), "key")
            .withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
            .withColumn("own", F.pmod(F.xxhash64("f"), F.col("blocks")).cast("int")))
    dealt = many.select(
        "f", "key", "own",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "f", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        F.explode(F.when(F.col("own") < F.col("other"), F.array(F.lit(False)))
                  .when(F.col("own") > F.col("other"), F.array(F.lit(True)))
                  .otherwise(F.array(F.lit(False), F.lit(True)))).alias("second"))
    met = dealt.groupBy("key", "i", "j").applyInPandas(meet, "a LONG, b LONG").distinct()
    return pairs.unionByName(met)


def _grouped(docs: DataFrame, shingle: int, radius: int, crowd: int, block: int) -> DataFrame:
    """Rows ``doc_id, text_hash, f, component``; the component is a fingerprint."""
    marked = stored(
        fingerprints(docs.select("doc_id", "text"), shingle)
        .select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
                F.col("fingerprint").alias("f")), "fingerprints")
    marks = marked.select("f").distinct()
    group = components(links(marks, radius, crowd, block))
    named = marks.join(group, marks["f"] == group["node"], "left").select(
        "f", F.coalesce("component", "f").alias("component"))
    return marked.join(named, "f")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                    crowd: int = CROWD, block: int = BLOCK) -> DataFrame:
    """Rows ``doc_id, fingerprint, component_id`` of all documents.

    ``component_id`` is the smallest id that can be reached through links.
    """
    rows = stored(_grouped(docs, shingle, radius, crowd, block), "groups")
    smallest = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows.join(smallest, "component").select(
        "doc_id", F.col("f").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS,
                         crowd: int = CROWD, block: int = BLOCK) -> DataFrame:
    """One document of every component: that of the smallest id.

    A missing id comes last. Of several texts under that id the one of smallest
    hash stays, and of equal rows one. Columns stay as they are.
    """
    return keep_first(docs, _grouped(docs, shingle, radius, crowd, block))


def keep_first(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The document of the smallest id of every component; ``rows`` has
    ``doc_id, text_hash, component`` of all documents."""
    return keep_text(docs, rows.groupBy("component", "doc_id", "text_hash").agg(
        F.count("*").alias("n")))


def first_order(*more: str) -> Column:
    """Which text of a component stays is the least by this."""
    return F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "text_hash", *more)


def keep_text(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """The first document of every component; ``texts`` has ``component, doc_id, text_hash``
    and the number ``n`` of rows, at least for the first text of every component."""
    first = texts.groupBy("component").agg(F.min(first_order("n")).alias("first"))
    keys = stored(first.select(F.col("first.doc_id").alias("_viewtide_id"),
                               F.col("first.text_hash").alias("_viewtide_hash"),
                               F.col("first.n").alias("_n")), "representatives")

    def of(chosen: DataFrame) -> DataFrame:
        same = docs["doc_id"].eqNullSafe(chosen["_viewtide_id"]) & (
            F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == chosen["_viewtide_hash"])
        return docs.join(chosen, same, "left_semi")
    # Only rows that are repeated need a second look.
    repeated = of(keys.filter("_n > 1"))
    kept = repeated.withColumn("_viewtide_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    return of(keys.filter("_n = 1")).unionByName(
        kept.dropDuplicates(["doc_id", "_viewtide_hash"]).drop("_viewtide_hash"))
