"""Ranked lexical search by one Aho-Corasick scan over the documents.

The terms of all items form one automaton. Every term is guarded by a border on
both sides, and the text is scanned with every run of other characters as borders,
so a match is a whole term and its count is the term frequency: the documents need
no index. The outputs of the automaton map terms to items. The scan writes one row
per document with the terms it holds; document frequencies are summed from these
rows, and a second pass over them scores all items of a document at once. Each task
keeps its best documents per item (bounded by items times the depth), and only those
meet in the final ranking, which is exact.

Items are dealt into blocks of about ``BLOCK_BYTES`` of text, one scan per block, so
the automaton that every worker holds stays bounded however many items there are. An
item is never divided.

Cases: a null text has no term, an item without a term has no result. Rows of one
item id are one item with the terms of all. Every row of documents is a document, so
a repeated row is ranked repeatedly; a missing ``doc_id`` comes after all others of
its score, a missing ``item_id`` is an item of its own. Ids are integers. An empty
table on either side gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from math import floor, log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide.llm.graph import stored
from viewtide.operators.topn import top_rows

# What a term is made of, and the scale of the integer scores.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SCALE = 1000
TF_SCALE = 1_000_000_000

DEPTH = 50
BLOCK_BYTES = 1 << 20
# Cells of the table of scores, and candidates, that a task holds at once.
_CELLS = 1 << 21
_PENDING = 1 << 18
_LAST_ID = np.iinfo(np.int64).max
_HITS = "doc_id LONG, n_terms LONG, terms ARRAY<INT>, counts ARRAY<LONG>"
_BEST = "item INT, doc_id LONG, no_id BOOLEAN, score LONG"

_SCANNED = bytes(byte if byte >= 128 or chr(byte).isalnum() else 32 for byte in range(256)
                 ).translate(bytes.maketrans(UPPER.encode(), LOWER.encode()))


def term_array(text: Column) -> Column:
    """All terms of a text in order; only A-Z are lower-cased."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER),
                                F.lit(f"({TERM})"), 1)


@lru_cache(maxsize=1)
def automaton(terms: tuple[str, ...]):
    """Automaton over guarded terms; the output of a term is its place in ``terms``."""
    import ahocorasick
    made = ahocorasick.Automaton()
    for place, term in enumerate(terms):
        made.add_word(f" {term} ", place)
    made.make_automaton()
    return made


def scan(text: str | None, terms: tuple[str, ...]) -> tuple[int, dict[int, int]]:
    """Number of terms of one whole text, and how often each of ``terms`` occurs."""
    if not text:
        return 0, {}
    octets = text.encode("utf-8", "surrogatepass").translate(_SCANNED)
    borders = np.frombuffer(octets, np.uint8) == 32
    n = int(np.count_nonzero(borders[:-1] & ~borders[1:])) + int(not borders[0])
    guarded = f" {octets.decode('utf-8', 'surrogatepass')} "
    return n, Counter(place for _, place in automaton(terms).iter(guarded))


def _hits(docs: DataFrame, terms: tuple[str, ...]) -> DataFrame:
    """One row per document with its number of terms and the counts of ``terms``."""
    def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [scan(text, terms) for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"),
                                "n_terms": [n for n, _ in found],
                                "terms": [list(counts) for _, counts in found],
                                "counts": [list(counts.values()) for _, counts in found]})
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        scanned, _HITS)


def term_weight(n_docs: int, df: int) -> int:
    return floor(SCALE * log((2 * n_docs + 2) / (2 * df + 1)))


def lengths(n_terms: np.ndarray, n_docs: int, n_all: int) -> np.ndarray:
    """The length part ``m`` of every document; exact whatever the sizes."""
    if len(n_terms) and int(n_terms.max()) * n_docs * 50 >= 1 << 63:
        return np.array([50 + 50 * int(n) * n_docs // n_all for n in n_terms], np.int64)
    return 50 + 50 * n_terms * n_docs // n_all


def _best(items: np.ndarray, docs: np.ndarray, no_id: np.ndarray, scores: np.ndarray,
          depth: int) -> np.ndarray:
    """Places of the ``depth`` best of every item, in the order of the ranking."""
    order = np.lexsort((docs, no_id, -scores, items))
    ordered = items[order]
    first = np.searchsorted(ordered, ordered, "left")
    return order[np.arange(len(order)) - first < depth]


class _Ranking:
    """The best documents of every item that a task has seen."""

    def __init__(self, n_items: int, depth: int):
        self.depth = depth
        self.least = np.ones(n_items, np.int64)
        self.kept = [np.empty(0, kind) for kind in (np.int64, np.int64, bool, np.int64)]
        self.waiting: list[list[np.ndarray]] = []
        self.n_waiting = 0

    def add(self, scores: np.ndarray, docs: np.ndarray, no_id: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.least)
        self.waiting.append([item, docs[row], no_id[row], scores[row, item]])
        self.n_waiting += len(row)
        if self.n_waiting > _PENDING:
            self.settle()

    def settle(self) -> None:
        parts = [np.concatenate(column) for column in
                 zip(self.kept, *self.waiting, strict=True)]
        best = _best(*parts, self.depth)
        self.kept = [part[best] for part in parts]
        self.waiting, self.n_waiting = [], 0
        items, ends = np.unique(self.kept[0][::-1], return_index=True)
        full = np.bincount(self.kept[0], minlength=len(self.least))[items] == self.depth
        # The kept rows are ordered, so the last of an item is its lowest score.
        self.least[items[full]] = self.kept[3][::-1][ends[full]]


def _ranked(hits: DataFrame, weights: np.ndarray, first: np.ndarray, items_of: np.ndarray,
            n_items: int, n_docs: int, n_all: int, depth: int) -> DataFrame:
    """The best documents per item of every task.

    ``items_of[first[t]:first[t + 1]]`` are the items of term ``t``.
    """
    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranking = _Ranking(n_items, depth)
        rows = max(1, _CELLS // n_items)
        for batch in batches:
            for at in range(0, len(batch), rows):
                part = batch.iloc[at:at + rows]
                sizes = part["terms"].map(len).to_numpy()
                terms = np.concatenate([np.asarray(t, np.int64) for t in part["terms"]])
                tf = np.concatenate([np.asarray(c, np.int64) for c in part["counts"]])
                m = np.repeat(lengths(part["n_terms"].to_numpy(np.int64), n_docs, n_all), sizes)
                share = weights[terms] * (TF_SCALE * tf // (SCALE * tf + 20 * m))
                row = np.repeat(np.arange(len(part)), sizes)
                # Every hit is repeated for the items of its term.
                fan = first[terms + 1] - first[terms]
                start = np.repeat(first[terms] - (np.cumsum(fan) - fan), fan)
                item = items_of[start + np.arange(fan.sum())]
                scores = np.zeros((len(part), n_items), np.int64)
                np.add.at(scores, (np.repeat(row, fan), item), np.repeat(share, fan))
                missing = part["doc_id"].isna().to_numpy()
                ranking.add(scores, part["doc_id"].fillna(_LAST_ID).to_numpy(np.int64), missing)
        ranking.settle()
        item, docs, no_id, score = ranking.kept
        yield pd.DataFrame({"item": item.astype("int32"), "doc_id": docs, "no_id": no_id,
                            "score": score})
    return hits.filter(F.size("terms") > 0).mapInPandas(scored, _BEST)


def _block(docs: DataFrame, items: DataFrame, totals: tuple[int, int] | None,
           depth: int) -> tuple[DataFrame, tuple[int, int]]:
    """The ranking of one block of items; ``items`` has ``item, item_id, term`` and is
    bounded by the size of a block."""
    spark = docs.sparkSession
    pairs = items.select("item", "term").toPandas()
    terms = tuple(sorted(set(pairs["term"])))
    place = {term: i for i, term in enumerate(terms)}
    term, item = pairs["term"].map(place).to_numpy(np.int64), pairs["item"].to_numpy(np.int64)
    items_of = item[np.argsort(term, kind="stable")]
    first = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(terms)))])
    hits = stored(_hits(docs, terms), "hits")
    if totals is None:
        row = hits.agg(F.count_if(F.col("n_terms") > 0), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
        totals = (row[0], row[1])
    if not totals[0]:
        return spark.createDataFrame([], "item_id LONG, doc_id LONG, score LONG"), totals
    df = np.zeros(len(terms), np.int64)
    counted = hits.select(F.explode("terms").alias("term")).groupBy("term").count().toPandas()
    df[counted["term"].to_numpy(np.int64)] = counted["count"].to_numpy(np.int64)
    weights = np.array([term_weight(totals[0], int(n)) for n in df], np.int64)
    best = _ranked(hits, weights, first, items_of, int(item.max()) + 1, *totals, depth)
    names = items.select("item", "item_id").distinct()
    named = best.join(F.broadcast(names), "item").select(
        "item_id", F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "score")
    return stored(named, "best"), totals


def rank_documents(docs: DataFrame, items: DataFrame, depth: int = DEPTH,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the best documents of every item.

    ``docs`` has ``doc_id`` and ``text``, ``items`` has ``item_id`` and ``text``.
    """
    terms = stored(items.select(
        F.col("item_id").cast("long").alias("item_id"),
        F.explode(F.array_distinct(term_array(F.col("text")))).alias("term")).distinct(), "terms")
    sizes = terms.groupBy("item_id").agg(F.sum(F.octet_length("term") + 2).alias("bytes"))
    total = sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    blocks = -(-total // block_bytes)
    best, totals = None, None
    for block in range(blocks):
        own = terms.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        ids = own.select("item_id").distinct().toPandas()["item_id"]
        if not len(ids):
            continue
        numbered = docs.sparkSession.createDataFrame(
            [(i, None if pd.isna(value) else int(value)) for i, value in enumerate(ids)],
            "item INT, item_id LONG")
        part, totals = _block(docs, own.join(F.broadcast(numbered), own["item_id"].eqNullSafe(
            numbered["item_id"])).select("item", own["item_id"], "term"), totals, depth)
        best = part if best is None else best.unionByName(part)
    if best is None:
        best = docs.sparkSession.createDataFrame([], "item_id LONG, doc_id LONG, score LONG")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    return top_rows(best, ["item_id"], order, depth).select("item_id", "rank", "doc_id", "score")


# The same ranking in SQL, over all documents and items.
SQL = f"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS row_no,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') AS terms
  FROM documents),
tokens AS (SELECT row_no, doc_id, unnest(terms) AS term FROM words),
item_terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark),
totals AS (
  SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_all
  FROM words WHERE len(terms) > 0),
counted AS (
  SELECT row_no, doc_id, term, count(*) AS tf FROM tokens
  WHERE term IN (SELECT term FROM item_terms) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor({SCALE} * ln((2 * max(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counted, totals GROUP BY term),
sizes AS (
  SELECT row_no, 50 + (50 * len(terms) * n_docs) // n_all AS m FROM words, totals
  WHERE len(terms) > 0),
scores AS (
  SELECT item_id, row_no, doc_id,
         CAST(sum(w * (({TF_SCALE} * tf) // ({SCALE} * tf + 20 * m))) AS BIGINT) AS score
  FROM item_terms JOIN counted USING (term) JOIN weights USING (term) JOIN sizes USING (row_no)
  GROUP BY ALL),
ranked AS (
  SELECT item_id, row_number() OVER (
    PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= {DEPTH}
"""
