"""Exact Jaccard self-join of word n-gram sets by grouped prefixes.

A text's set holds its distinct shingles, each as a 64-bit hash. All sets are sorted
by one order of shingles. Two sets of the wanted similarity then share a shingle among
the first few of both: of the larger one as many as its own bound leaves, of the
smaller one fewer still. So the join needs only these prefixes.

The order puts frequent shingles last. A first pass over all texts counts the shingles
that repeat within a slice of a task; the ``HOT`` most frequent of them (a bounded list)
follow all others, which are ordered by hash. Any order gives the same links, so neither
the slices nor the bound of the list cost a result.

Equal sets are one node. Nodes of equal prefix and size form a group, and groups are
joined instead of nodes: on a shared shingle, with the bounds that size and position
allow. Pairs of groups are expanded to members and verified on whole sets:

1. every member is compared with the least member of its group, and the least member of
   every group with that of the group it shares most shingles with, among the least groups
   of its shingles (in a crowded shingle also with the least of a similar size). These are
   no more pairs than groups, and they link most of what belongs together;
2. the least members of any two joined groups that are not connected yet are compared;
3. what may still hold unlinked similar members (a group, a pair of groups, a crowded
   shingle whose members are in more than one component; shingles with the same least
   group are one unit) is compared completely: its members are dealt into blocks, two
   blocks that are not connected yet meet once, and their common shingles are counted by
   an inverted index. A group of a task never holds more than two blocks.

The pairs of a cluster are verified in one place, to which the text of every node goes
once, so what is shuffled grows with the nodes and not with the pairs; only a cluster that
is larger than a block is dealt into blocks, and pairs meet where theirs do.
Large tables are deleted as soon as what follows from them is written.

No member, group or candidate is left out, whatever the skew.

Cases: null and wordless texts have the empty set and are linked with nothing. A text
of fewer words than a shingle is one shingle. Repeated rows are kept and linked with
each other. A missing id names no component unless its component has no other id. An
empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide.llm.graph import components, stored
from viewtide.llm.simhash import first_order
from viewtide.storage import remove, scratch_path

# Words, and the case that is folded.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SHINGLE = 5
PERCENT = 80
# Groups that share a shingle are joined in pairs up to CROWD, otherwise by stars.
CROWD = 256
# Members of one block of an exhaustive comparison, and shingles of all its members.
BLOCK = 1024
_BLOCK_SHINGLES = 1 << 19
# Shingles that are moved to the end of the order, at most; they repeat at least REPEATED
# times within COUNTED shingles of one task.
HOT = 1 << 16
REPEATED = 8
COUNTED = 1 << 22
# Bits of the bitmap of wanted texts, at most: 16 MB.
_MOST_BITS = 1 << 27
_SEED = 13
# Bytes of text hashed at once.
_SLICE = 1 << 18
# Rows whose sets a worker holds at once.
_ROWS = 1 << 10
_random = np.random.default_rng(_SEED)
_BYTES = _random.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES[_SPACE] = _BYTES[0x20]
_BASE, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(size: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``size`` of each."""
    if len(_powers[0]) < size:
        for place, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            factors = np.full(size, np.uint64(base))
            factors[0] = 1
            _powers[place] = np.multiply.accumulate(factors)
    return _powers


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of one whole text, as signed integers.

    The words are laid out with one space between them; a shingle is a range of these
    bytes, and its hash comes from the difference of two running sums.
    """
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)
    space = _SPACE[raw]
    keep = ~space
    keep[1:] |= ~space[:-1]
    words, gaps = raw[keep], np.flatnonzero(space[keep])
    if not len(words):
        return np.empty(0, np.int64)
    ends = gaps if len(gaps) and gaps[-1] == len(words) - 1 else np.append(gaps, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(ends))
    first, last = starts[:len(ends) - width + 1], ends[width - 1:]
    found, at = [], 0
    while at < len(first):
        until = max(at + 1, int(np.searchsorted(last, first[at] + _SLICE)))
        low, high = int(first[at]), int(last[until - 1])
        power, inverse = _power_tables(max(_SLICE, high - low) + 1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(
            _BYTES[words[low:high]] * power[:high - low])])
        a, b = first[at:until] - low, last[at:until] - low
        hashes = (sums[b] - sums[a]) * inverse[a]
        hashes = (hashes ^ (hashes >> np.uint64(32))) * _MIX
        found.append(hashes ^ (hashes >> np.uint64(29)))
        at = until
    hashes = np.concatenate(found).view(np.int64)
    hashes.sort()
    return hashes[np.concatenate([[True], hashes[1:] != hashes[:-1]])]


def prefix_size(size, percent: int = PERCENT):
    """How many leading shingles of a set suffice to meet a set that is no larger."""
    return size - -(-percent * size // 100) + 1


def index_size(size, percent: int = PERCENT):
    """How many leading shingles of a set suffice to meet a set that is no smaller."""
    return size - -(-2 * percent * size // (100 + percent)) + 1


def ordered_prefix(shingles: np.ndarray, hot: np.ndarray, rank: np.ndarray,
                   percent: int = PERCENT) -> np.ndarray:
    """The prefix of a set; ``hot`` (sorted) come after all others, by ``rank``."""
    size = prefix_size(len(shingles), percent)
    if not len(hot) or not len(shingles):
        return shingles[:size] if len(shingles) else shingles
    at = np.minimum(np.searchsorted(hot, shingles), len(hot) - 1)
    is_hot = hot[at] == shingles
    last = shingles[is_hot][np.argsort(rank[at[is_hot]], kind="stable")]
    return np.concatenate([shingles[~is_hot], last])[:size]


def reaches(both, size_a, size_b, percent: int = PERCENT):
    """Whether two sets with ``both`` common shingles have the similarity."""
    return 100 * both >= percent * (size_a + size_b - both)


def _heavy(frame: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Writes a table that took a wide shuffle and lets Spark drop that shuffle's files.

    It keeps them until the driver collects its garbage, which a driver that mostly waits
    may not do before the disks of the executors are full.
    """
    table = stored(frame, name, path)
    frame.sparkSession.sparkContext._jvm.System.gc()
    return table


def _text_key(text: Column) -> list[Column]:
    """What tells texts apart without carrying them: 128 bits and the size."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole).alias("t1"), F.xxhash64(F.lit(_SEED), whole).alias("t2"),
            F.octet_length(whole).alias("t3")]


_KEY = ["t1", "t2", "t3"]


def _repeated(tokens: np.ndarray) -> pd.DataFrame:
    """Tokens found at least ``REPEATED`` times, and their counts. Sorts its argument."""
    tokens.sort()
    apart = REPEATED - 1
    token = np.unique(tokens[apart:][tokens[apart:] == tokens[:len(tokens) - apart]]) if len(
        tokens) > apart else np.empty(0, np.int64)
    n = np.searchsorted(tokens, token, "right") - np.searchsorted(tokens, token, "left")
    return pd.DataFrame({"token": token, "n": n}, dtype="i8")


def _frequent(docs: DataFrame, shingle: int, hot: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, and their counts."""
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # One buffer, filled and sorted in place: a worker needs no second copy of it.
        held, size = np.empty(COUNTED, np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                found = shingle_set(text, shingle)
                while len(found):
                    if size == COUNTED:
                        yield _repeated(held)
                        size = 0
                    part, found = found[:COUNTED - size], found[COUNTED - size:]
                    held[size:size + len(part)] = part
                    size += len(part)
        yield _repeated(held[:size])
    found = docs.select("text").mapInPandas(counted, "token LONG, n LONG").groupBy("token").agg(
        F.sum("n").alias("n")).orderBy(F.col("n").desc(), "token").limit(hot).toPandas()
    found = found.sort_values("token")
    return found["token"].to_numpy(np.int64), found["n"].to_numpy(np.int64)


def _marks(docs: DataFrame, shingle: int, percent: int, hot: np.ndarray, rank: np.ndarray
           ) -> DataFrame:
    """Per row: id, text key, two hashes of the set and of the prefix, size and prefix."""
    schema = ("doc_id LONG, t1 LONG, t2 LONG, t3 INT, h1 LONG, h2 LONG, g1 LONG, g2 LONG, "
              "size INT, prefix ARRAY<LONG>")

    def digests(values: list[np.ndarray]) -> np.ndarray:
        import xxhash
        return np.array([divmod(xxhash.xxh3_128_intdigest(v.tobytes()), 1 << 64)
                         for v in values], np.uint64).reshape(-1, 2).view(np.int64)

    def marked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (whole.iloc[at:at + _ROWS] for whole in batches
                      for at in range(0, len(whole), _ROWS)):
            sets = [shingle_set(text, shingle) for text in batch["text"]]
            prefixes = [ordered_prefix(s, hot, rank, percent) for s in sets]
            of_sets, of_prefixes = digests(sets), digests(prefixes)
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "t1": batch["t1"], "t2": batch["t2"],
                "t3": batch["t3"], "h1": of_sets[:, 0], "h2": of_sets[:, 1],
                "g1": of_prefixes[:, 0], "g2": of_prefixes[:, 1],
                "size": [len(s) for s in sets], "prefix": prefixes})
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       *_text_key(F.col("text"))).mapInPandas(marked, schema)


def _maybe_wanted(wanted: DataFrame) -> Callable[[Column], Column]:
    """Test of a text key against a bitmap of the wanted ones.

    It lets a few others pass, so that hardly any unwanted text is shuffled. The bitmap
    has at most ``_MOST_BITS`` bits, whatever the number of wanted texts.
    """
    bits = min(_MOST_BITS, 1 << max(15, (32 * wanted.count()).bit_length()))
    bit = F.pmod("t1", F.lit(bits))
    rows = wanted.select((bit + 1).alias("bit")).groupBy(
        F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("map")).collect()
    octets = np.zeros(bits // 8, np.uint8)
    for row in rows:
        start = (row["bucket"] - 1) * len(row["map"])
        octets[start:start + len(row["map"])] = np.frombuffer(row["map"], np.uint8)

    @F.pandas_udf("boolean")
    def known(keys: pd.Series) -> pd.Series:
        place = keys.to_numpy(np.int64)
        return pd.Series((octets[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1)
    return lambda key: known(F.pmod(key, F.lit(bits)))


def _shipped(docs: DataFrame, nodes: DataFrame, places: DataFrame) -> DataFrame:
    """The text of every node at each of its places: ``places`` with ``node`` and a ``text``.

    Copies of a text are reduced to one in every task, before they are shuffled.
    """
    columns = [name for name in places.columns if name != "node"]
    wanted = stored(nodes.select("node", *_KEY).join(places.groupBy("node").agg(
        F.collect_list(F.struct(*columns)).alias("places")), "node"), "wanted")
    texts = docs.select("text", *_text_key(F.col("text"))).filter(
        _maybe_wanted(wanted)(F.col("t1"))).groupBy(*_KEY).agg(F.first("text").alias("text"))
    return texts.join(wanted, _KEY).select(
        "node", "text", F.explode("places").alias("place")).select("node", "text", "place.*")


def _parts(n: Column, shingles: Column, block: int) -> Column:
    """How many blocks so many members with so many shingles take."""
    return F.greatest(F.ceil(n / block), F.ceil(shingles / _BLOCK_SHINGLES), F.lit(1)).cast("int")


class _Forest:
    """Components that links make of nodes, and the links that joined two of them."""

    def __init__(self) -> None:
        self.parent: dict = {}
        self.links: list[tuple] = []

    def root(self, node):
        parent = self.parent
        while parent.setdefault(node, node) != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    def join(self, a, b) -> bool:
        first, second = self.root(a), self.root(b)
        self.parent[first] = second
        return first != second


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int, percent: int,
              block: int) -> DataFrame:
    """Links ``a, b`` that connect all that the pairs of the similarity connect.

    The pairs of a cluster mostly have one least node: they are a unit. Small units share a
    block; the nodes of a large one are dealt into blocks of its own, and a pair goes to the
    blocks of its nodes.
    """
    def check(asked: pd.DataFrame, texts: pd.DataFrame) -> pd.DataFrame:
        sets = {node: shingle_set(text, shingle) for node, text in zip(
            texts["node"].tolist(), texts["text"], strict=True)}
        forest = _Forest()
        for a, b in zip(asked["a"].tolist(), asked["b"].tolist(), strict=True):
            if forest.root(a) != forest.root(b):
                x, y = sets[a], sets[b]
                if reaches(min(len(x), len(y)), len(x), len(y), percent) and reaches(
                        len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent):
                    forest.join(a, b)
                    forest.links.append((a, b))
        return pd.DataFrame(forest.links, columns=["a", "b"], dtype="i8")

    least = pairs.groupBy(F.col("b").alias("a")).agg(F.min("a").alias("unit"))
    named = stored(pairs.join(least, "a", "left").select(
        F.coalesce("unit", "a").alias("unit"), "a", "b"), "named_pairs")
    totals = stored(named.select("unit", F.explode(F.array("a", "b")).alias("node")).distinct().join(
        nodes.select("node", "size"), "node").groupBy("unit").agg(
        F.count("*").alias("n"), F.sum("size").alias("shingles")).withColumn(
        "parts", _parts(F.col("n"), F.col("shingles"), block)), "totals")
    pool = totals.filter("parts = 1").agg(
        F.sum("n").alias("n"), F.sum("shingles").alias("shingles")).select(
        _parts(F.coalesce("n", F.lit(0)), F.coalesce("shingles", F.lit(0)), block)).first()[0]
    # Large units are few: each has more nodes or shingles than a block.
    large = F.broadcast(totals.filter("parts > 1").select("unit", "parts"))

    def part(node: str) -> Column:
        return F.when(F.col("parts") > 1, F.pmod(F.xxhash64(node), "parts")).otherwise(
            F.pmod(F.xxhash64("unit"), F.lit(pool))).cast("int")
    dealt = stored(named.join(large, "unit", "left").select(
        F.when(F.col("parts") > 1, F.col("unit")).otherwise(-1).alias("own"),
        F.least(part("a"), part("b")).alias("i"), F.greatest(part("a"), part("b")).alias("j"),
        "a", "b"), "dealt")
    key = ["own", "i", "j"]
    asked = dealt.select(*key, F.explode(F.array("a", "b")).alias("node")).distinct()
    return dealt.groupBy(*key).cogroup(_shipped(docs, nodes, asked).groupBy(*key)).applyInPandas(
        check, "a LONG, b LONG")


def _may_meet(a: str, b: str, percent: int) -> Column:
    """Whether two groups may be similar if this is the first shingle that they share.

    ``a`` and ``b`` are structs with ``size`` and ``pos`` (from 0) of the shingle. A
    similar pair passes at its first shared shingle, in the shorter prefix of the smaller.
    """
    p, q = F.col(f"{a}.size"), F.col(f"{b}.size")
    small = F.when(p <= q, F.col(f"{a}.pos")).otherwise(F.col(f"{b}.pos"))
    least = F.least(p, q)
    indexed = small < least - _ceil_div(2 * percent * least, 100 + percent) + 1
    rest = 1 + F.least(p - F.col(f"{a}.pos") - 1, q - F.col(f"{b}.pos") - 1)
    return indexed & ((100 + percent) * rest >= percent * (p + q))


def _overlap_bound(percent: int) -> Column:
    """How many shingles a pair of groups can share at most, from its shared prefix.

    Of two prefixes one ends first in the order. What is shared but was not counted lies
    behind the end of that one, and in the other set behind its last counted shingle; or
    it is one of the crowded shingles, which are not counted in pairs.
    """
    def behind(size: str) -> Column:
        return F.col(size) - (F.col(size) - _ceil_div(percent * F.col(size), 100) + 1)
    first = F.least(behind("p"), F.col("q") - F.col("last_b") - 1)
    second = F.least(behind("q"), F.col("p") - F.col("last_a") - 1)
    crowded = F.least(F.coalesce("crowded_a", F.lit(0)), F.coalesce("crowded_b", F.lit(0)))
    return F.col("shared") + F.greatest(first, second) + crowded


def _ceil_div(value: Column, by: int) -> Column:
    return F.floor((value + (by - 1)) / by)


def _forest(nodes: list, known: list, sets: list, second: list, percent: int) -> list[tuple]:
    """Links of a spanning forest between two blocks (one block: given twice), beyond
    the components that are known already."""
    forest = _Forest()
    for node, component in zip(nodes, known, strict=True):
        forest.join((0, node), (1, component))

    def meet(left: list[int], right: list[int]) -> None:
        sizes = np.array([len(sets[i]) for i in right], np.int64)
        values = np.concatenate([sets[i] for i in right] or [np.empty(0, np.int64)])
        owner = np.repeat(np.arange(len(right)), sizes)
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        for i in left:
            first = np.searchsorted(values, sets[i], "left")
            count = np.searchsorted(values, sets[i], "right") - first
            at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
            both = np.bincount(owner[at], minlength=len(right))
            for j in np.flatnonzero(reaches(both, sizes, len(sets[i]), percent)).tolist():
                if forest.join((0, nodes[i]), (0, nodes[right[j]])):
                    forest.links.append((nodes[i], nodes[right[j]]))

    # Members of the largest known component are not compared with each other.
    most = next((component for component, _ in Counter(known).most_common(1)), None)
    left = [i for i, other in enumerate(second) if not other]
    right = [i for i, other in enumerate(second) if other]
    meet([i for i in left if known[i] != most], right)
    if {nodes[i] for i in left} != {nodes[i] for i in right}:
        meet([i for i in right if known[i] != most], [i for i in left if known[i] == most])
    return forest.links


def _dealt(units: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int, percent: int,
           block: int) -> DataFrame:
    """Links inside exhaustive units. ``units`` has ``unit, node, component``.

    A large component of a unit has blocks of its own, small ones share blocks. Blocks
    of one large component never meet: their members are connected.
    """
    def meet(group: pd.DataFrame) -> pd.DataFrame:
        made = [shingle_set(text, shingle) for text in group["text"]]
        side = group["side"].to_numpy()
        at = np.concatenate([np.flatnonzero(side != 1), np.flatnonzero(side != 0)])
        second = np.repeat([False, True], [np.sum(side != 1), np.sum(side != 0)])
        node, component = (group[name].to_numpy(np.int64)[at] for name in ("node", "component"))
        return pd.DataFrame(_forest(
            node.tolist(), component.tolist(), [made[i] for i in at.tolist()], second.tolist(),
            percent), columns=["a", "b"], dtype="i8")

    sizes = units.join(nodes.select("node", "size"), "node").groupBy("unit", "component").agg(
        F.count("*").alias("n"), F.sum("size").alias("shingles"))
    large = (F.col("n") * 2 > block) | (F.col("shingles") * 2 > _BLOCK_SHINGLES)
    pools = sizes.groupBy("unit").agg(*(F.coalesce(F.sum(F.when(~large, F.col(name))), F.lit(0))
                                        .alias(f"pooled_{name}") for name in ("n", "shingles")))
    parts = F.when(large, _parts(F.col("n"), F.col("shingles"), block)).otherwise(
        _parts(F.col("pooled_n"), F.col("pooled_shingles"), block))
    shares = stored(sizes.join(pools, "unit").select(
        "unit", "component", F.when(large, F.col("component")).otherwise(-1).alias("own"),
        parts.alias("parts")), "shares")
    part = F.pmod(F.when(F.col("own") < 0, F.xxhash64("component"))
                  .otherwise(F.xxhash64("node")), "parts").cast("int")
    placed = stored(units.join(shares, ["unit", "component"]).select(
        "unit", "node", "component", "own", part.alias("part")), "placed")
    place = F.struct("own", "part")
    blocks = placed.groupBy("unit", place.alias("i")).agg(
        F.min("component").alias("low"), F.max("component").alias("high"))
    other = blocks.select("unit", F.col("i").alias("j"), F.col("low").alias("low2"),
                          F.col("high").alias("high2"))
    met = stored(blocks.join(other, "unit").filter(
        (F.col("i") <= F.col("j")) & (F.least("low", "low2") < F.greatest("high", "high2"))
    ).select("unit", "i", "j"), "met")
    # Side 0 is compared with side 1; a block that meets itself comes once, as side 2.
    members = placed.select("unit", "node", "component", place.alias("i"))
    left = members.join(met, ["unit", "i"]).withColumn(
        "side", F.when(F.col("i") == F.col("j"), 2).otherwise(0))
    right = members.withColumnRenamed("i", "j").join(
        met.filter("i <> j"), ["unit", "j"]).withColumn("side", F.lit(1))
    return _shipped(docs, nodes, left.unionByName(right)).groupBy("unit", "i", "j").applyInPandas(
        meet, "a LONG, b LONG")


def _size_band(size: Column, percent: int) -> Column:
    """Sizes that allow the similarity lie in the same band or in adjacent ones."""
    return F.floor(F.log(size.cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9).cast("int")


def _joined(nodes: DataFrame, prefixes: DataFrame, docs: DataFrame, shingle: int,
            percent: int, crowd: int, block: int, consumed: str) -> DataFrame:
    """``node, component`` of all linked nodes.

    ``nodes`` has ``node``, the text key, ``size`` and the group ``g1, g2``; ``prefixes``
    has the prefix of every group, from the table ``consumed``, which is deleted.
    """
    spark = docs.sparkSession
    key = ["g1", "g2", "size"]
    grouped = nodes.groupBy(*key).agg(F.min("node").alias("rep"), F.count("*").alias("members"))
    with_prefix = scratch_path(spark, "prefixes")
    full = _heavy(grouped.join(prefixes, key), "prefixes", with_prefix)
    remove(spark, consumed)
    groups = stored(full.drop("prefix"), "groups")
    several = groups.filter("members > 1").select(*key, "rep")
    member_of = stored(nodes.join(several, key).select("node", "rep"), "member_of")
    # Size and position share a number: this is the widest shuffle.
    index = full.select("rep", "size", F.posexplode("prefix").alias("pos", "token")).select(
        "token", "rep", (F.shiftleft(F.col("size").cast("long"), 32) + F.col("pos")).alias("place"))
    keys = _heavy(index.groupBy("token").agg(
        F.count("*").alias("n"), F.min("rep").alias("lead")).filter("n > 1"), "keys")
    # An explode is sized too low: no side of a join on its rows may be broadcast.
    shared = _heavy(index.join(keys.hint("merge"), "token").select(
        "token", "n", "lead", "rep", F.shiftright("place", 32).alias("size"),
        F.col("place").bitwiseAND((1 << 32) - 1).alias("pos")), "shared")
    remove(spark, with_prefix)

    crowds = shared.filter(F.col("n") > crowd)
    # Stars of crowded shingles: in every band of sizes, and across to the next one.
    band = _size_band(F.col("size"), percent)
    many = stored(crowds.select(
        "token", "rep", "size", F.explode(F.array(band, band + 1)).alias("band")), "crowded")
    lowest = many.groupBy("token", "band").agg(F.min(F.struct("rep", "size")).alias("low"))
    # Shingles of one text mostly have the same members: those with the same least group
    # are one unit, which holds all of their pairs and each member once.
    led = stored(many.join(lowest, ["token", "band"]).select(
        "band", F.col("low.rep").alias("low"), F.col("low.size").alias("low_size"), "rep", "size"
    ).distinct(), "led")
    stars = led.filter((F.col("low") < F.col("rep")) & (
        100 * F.least("size", "low_size") >= percent * F.greatest("size", "low_size"))).select(
        F.col("low").alias("a"), F.col("rep").alias("b"))
    inside = member_of.filter("rep < node").select(F.col("rep").alias("a"), F.col("node").alias("b"))
    # A quarter of a prefix in common makes a pair worth a look before all others.
    leads = shared.filter("lead < rep").groupBy("rep", "lead").agg(
        F.count("*").alias("common"), F.max("size").alias("size")).filter(
        4 * F.col("common") >= F.col("size") - _ceil_div(percent * F.col("size"), 100) + 1).groupBy(
        "rep").agg(F.max_by("lead", "common").alias("a")).select("a", F.col("rep").alias("b"))

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        return _heavy(_verified(_heavy(pairs.distinct(), name), nodes, docs, shingle, percent,
                                block), "links")

    def spans_of(group: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Component of every member of a group, and their range for every group."""
        members = groups.filter("members = 1").select("rep", F.col("rep").alias("node")).unionByName(
            member_of.select("rep", "node"))
        named = stored(members.join(group, "node", "left").select(
            "rep", "node", F.coalesce("component", "node").alias("component")), "named")
        return named, stored(named.groupBy("rep").agg(
            F.min("component").alias("low"), F.max("component").alias("high")), "spans")

    links = verified(leads.unionByName(stars).unionByName(inside), "proposed")
    _, spans = spans_of(components(links))

    # A group of one component is not joined within it; one of several has a mark of its own.
    marks = spans.select("rep", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(
        -1 - F.col("rep")).alias("mark")).filter("mark <> rep")
    few = shared.filter(F.col("n") <= crowd).join(marks.hint("merge"), "rep", "left").select(
        "token", F.struct("rep", "size", "pos", F.coalesce("mark", "rep").alias("mark")).alias("s"))
    least, most = F.least("a.size", "b.size"), F.greatest("a.size", "b.size")
    met = few.select("token", F.col("s").alias("a")).join(
        few.select("token", F.col("s").alias("b")).hint("merge"), "token").filter(
        (F.col("a.rep") < F.col("b.rep")) & (F.col("a.mark") != F.col("b.mark"))
        & (100 * least >= percent * most))
    counted = met.groupBy(F.col("a.rep").alias("a"), F.col("b.rep").alias("b"),
                          F.col("a.size").alias("p"), F.col("b.size").alias("q")).agg(
        F.count("*").alias("shared"), F.max("a.pos").alias("last_a"),
        F.max("b.pos").alias("last_b"), F.bool_or(_may_meet("a", "b", percent)).alias("may"))
    in_crowds = stored(crowds.groupBy("rep").agg(F.count("*").alias("n")), "in_crowds")
    close = counted.filter("may").join(
        in_crowds.select(F.col("rep").alias("a"), F.col("n").alias("crowded_a")), "a", "left").join(
        in_crowds.select(F.col("rep").alias("b"), F.col("n").alias("crowded_b")), "b", "left"
    ).filter((100 + percent) * _overlap_bound(percent) >= percent * (F.col("p") + F.col("q")))
    pairs = _heavy(close.select("a", "b"), "group_pairs")
    wide_groups = several.select("rep")
    wide = pairs.join(wide_groups.withColumnRenamed("rep", "a"), "a", "left_semi").unionByName(
        pairs.join(wide_groups.withColumnRenamed("rep", "b"), "b", "left_semi")).distinct()
    links = stored(links.unionByName(verified(pairs, "group_pairs")), "links")
    group = stored(components(links), "components")

    # What the first steps may have left open: judged by groups, expanded to members.
    named, spans = spans_of(group)
    in_groups = spans.filter("low < high").select(
        F.concat(F.lit("g"), "rep").alias("unit"), "rep")
    ends = wide.select(F.concat_ws("-", "a", "b").alias("unit"),
                                       F.explode(F.array("a", "b")).alias("rep"))
    crowd_units = led.select(F.concat_ws("/", "low", "band").alias("unit"), "rep")
    units = stored(ends.unionByName(crowd_units).join(spans, "rep"), "units")
    open_units = units.groupBy("unit").agg(
        F.min("low").alias("low"), F.max("high").alias("high")).filter("low < high")
    open_reps = units.join(open_units.select("unit"), "unit").select("unit", "rep").unionByName(
        in_groups)
    rest = stored(open_reps.join(named, "rep").select("unit", "node", "component"), "open")
    if rest.isEmpty():
        return group
    more = _heavy(_dealt(rest, nodes, docs, shingle, percent, block), "more")
    return components(stored(links.unionByName(more).distinct(), "all_links"))


def _linked(docs: DataFrame, shingle: int, percent: int, crowd: int, block: int, hot: int
            ) -> tuple[DataFrame, DataFrame]:
    """The marks of every row, and ``h1, h2, least_id, component`` of every set with words."""
    spark = docs.sparkSession
    with_prefix = scratch_path(spark, "marks")
    marks = stored(_marks(docs, shingle, percent, *_frequent(docs, shingle, hot)), "marks",
                   with_prefix)
    rows = stored(marks.drop("prefix"), "rows")
    distinct = rows.filter("size > 0").groupBy("h1", "h2", "g1", "g2", "size").agg(
        F.min(F.struct(*_KEY)).alias("t"), F.min("doc_id").alias("least_id"))
    # Once written, the numbers of the nodes are fixed.
    nodes = stored(distinct.select(
        F.monotonically_increasing_id().alias("node"), "h1", "h2", "g1", "g2", "size", "t.*",
        "least_id"), "nodes")
    prefixes = marks.filter("size > 0").groupBy("g1", "g2", "size").agg(
        F.first("prefix").alias("prefix"))
    linked = _joined(nodes, prefixes, docs, shingle, percent, crowd, block, with_prefix)
    return rows, nodes.select("node", "h1", "h2", "least_id").join(linked, "node", "left").select(
        "h1", "h2", "least_id", F.coalesce("component", "node").alias("component"))


def link_documents(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT,
                   crowd: int = CROWD, block: int = BLOCK, hot: int = HOT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    Texts are linked where ``100 * common >= percent * union``; ``component_id`` is the
    smallest id that links reach.
    """
    rows, own = _linked(docs, shingle, percent, crowd, block, hot)
    least = own.groupBy("component").agg(F.min("least_id").alias("component_id"))
    found = stored(own.join(least, "component").select("h1", "h2", "component_id"), "found")
    size = F.col("size").cast("long").alias("n_shingles")
    return rows.filter("size > 0").select("doc_id", size, "h1", "h2").join(
        found, ["h1", "h2"]).select("doc_id", "n_shingles", "component_id").unionByName(
        rows.filter("size = 0").select("doc_id", size, F.col("doc_id").alias("component_id")))


def first_texts(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT,
                crowd: int = CROWD, block: int = BLOCK, hot: int = HOT) -> DataFrame:
    """``component, doc_id, text_hash, n``: the first text of every distinct set, with the
    number of its rows. Wordless texts are one set, in component -1.

    Sets are reduced before they meet their component, so copies are no hot key.
    """
    rows, own = _linked(docs, shingle, percent, crowd, block, hot)
    texts = rows.groupBy("h1", "h2", "size", "doc_id", F.col("t1").alias("text_hash")).agg(
        F.count("*").alias("n"))
    first = stored(texts.groupBy("h1", "h2", (F.col("size") > 0).alias("worded")).agg(
        F.min(first_order("n")).alias("first")), "first")
    worded = first.filter("worded").join(own.select("h1", "h2", "component"), ["h1", "h2"])
    return worded.unionByName(
        first.filter("not worded").withColumn("component", F.lit(-1).cast("long")),
        allowMissingColumns=True).select(
        "component", "first.doc_id", "first.text_hash", "first.n")


# The same links in SQL: all pairs of documents that share a shingle are counted.
SQL = f"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{_CAPITALS}', '{_SMALL}'),
                            '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS MATERIALIZED (
  SELECT row_no, doc_id, CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + {SHINGLE - 1}], ' ')
                        for i in range(1, len(w) - {SHINGLE} + 2)]) END AS shingles
  FROM words),
distinct_sets AS MATERIALIZED (
  SELECT min(row_no) AS node, shingles, len(shingles) AS n FROM (
    SELECT row_no, list_sort(shingles) AS shingles FROM sets WHERE len(shingles) > 0)
  GROUP BY shingles),
tokens AS MATERIALIZED (SELECT node, n, unnest(shingles) AS shingle FROM distinct_sets),
pairs AS (
  SELECT a.node AS x, b.node AS y FROM tokens a JOIN tokens b ON a.shingle = b.shingle
  WHERE a.node < b.node AND 100 * least(a.n, b.n) >= {PERCENT} * greatest(a.n, b.n)
  GROUP BY a.node, b.node, a.n, b.n
  HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
edges AS MATERIALIZED (SELECT x, y FROM pairs UNION SELECT y, x FROM pairs),
reach AS (
  SELECT node AS x, node AS y FROM distinct_sets
  UNION
  SELECT reach.x, edges.y FROM reach JOIN edges ON reach.y = edges.x),
named AS (
  SELECT s.row_no, s.doc_id, len(s.shingles) AS n, d.node
  FROM sets s JOIN distinct_sets d ON list_sort(s.shingles) = d.shingles),
least AS (
  SELECT reach.x AS node, min(named.doc_id) AS component_id
  FROM reach JOIN named ON named.node = reach.y GROUP BY reach.x)
SELECT named.doc_id, CAST(named.n AS BIGINT) AS n_shingles, least.component_id
FROM named JOIN least USING (node)
UNION ALL
SELECT doc_id, CAST(0 AS BIGINT), doc_id FROM sets WHERE len(shingles) = 0
"""
