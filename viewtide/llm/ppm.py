"""Language-model scores by prediction by partial matching.

The model is a trie of byte contexts up to ``ORDER`` bytes with the number of
times each byte followed. A byte is coded in its longest known context; if it
never followed there, an escape is coded and the next shorter context is asked,
where the bytes of the longer one are excluded because the escape has ruled them
out. An escape is as likely as the number of different bytes seen in a context
(estimate C). Below the empty context all bytes left are equally likely. The
trie is pretrained on all documents outside the held-out fold. A document's
score is the sum over its bytes of the logarithm of their probability.

A document is read as its words, small A-Z, with one space between, and an end
mark. Next to it stands the smoothed word model ``base_score``.

Both models grow with the corpus, so no task holds them. Documents are cut into
chunks of bounded size, which are written packed, with the distinct words and byte
strings that they use. Byte strings are dealt by their short context into parts,
words by their checksum, and a chunk holds one packed row for each part. What all
chunks have of a part meets in one partition: there counts are summed, each byte
string gets its code length once, and each chunk gets the packed values of what it
uses. A task holds the packed rows of its partition (a few bytes for every byte
string, or word, and chunk) and its different words, so
``spark.sql.shuffle.partitions`` has to grow with the corpus. The only part of
the trie that every task gets is that of contexts of at most two bytes: at most
2**24 entries, and a few thousand in text of one script.

Cases: null, empty and wordless texts are an end mark only. Repeated rows are
kept and scored alike. A null id belongs to the held-out fold. Without training
documents every byte is equally likely.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import partial
from itertools import chain
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtide.storage import scratch_path

ORDER = 5
FOLDS = 10
CHUNK_BYTES = 16 << 20
# Bytes whose grams are sorted at a time.
SORTED_BYTES = 4 << 20
# Packed numbers that are unpacked and summed at a time, and the parts of a chunk
# that meet in one shuffle partition.
SUMMED = 1 << 20
PARTS = 8
SMOOTHING = 0.1

# Bytes that no UTF-8 text holds: before the start, and the end of a document.
START, END = 0xFE, 0xFF
SYMBOLS = 256
END_WORD = b"\n"
SHORT = 2  # bytes of the contexts that every task gets

CHUNKS = ("chunk LONG, documents BINARY, low LONG, n LONG, part INT, words BINARY, "
          "grams BINARY, counts BINARY")
VALUES = "chunk LONG, grams BINARY, codes BINARY, table BINARY"
WORDS = "chunk LONG, words BINARY, counts BINARY, total LONG, kinds LONG"
SCORES = ("doc_id LONG, held_out BOOLEAN, n_tokens LONG, n_known LONG, train_tokens LONG, "
          "base_score DOUBLE, score DOUBLE")


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def tokens_of(text: str | None) -> str:
    """Words with one space between; only ASCII white space separates words."""
    # Bytes know no other letters and no other white space than ASCII.
    octets = (text or "").encode("utf-8", "surrogatepass").lower()
    return b" ".join(octets.split()).decode("utf-8", "surrogatepass")


def grams(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Every byte with its context, packed in a LONG, and the bytes per text."""
    start, end = bytes([START]) * order, bytes([END])
    coded = [text.encode() for text in texts]
    stream = np.frombuffer(b"".join(start + text + end for text in coded), np.uint8)
    packed = np.zeros(max(0, len(stream) - order), np.int64)
    for i in range(order + 1):
        packed <<= 8
        packed |= stream[i:len(packed) + i]
    return packed[(packed & 255) != START], np.array([len(text) + 1 for text in coded], np.int64)


def counted_grams(texts: Iterable[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Different grams of texts and their numbers, a few megabytes at a time."""
    keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(block: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found, number = np.unique(grams(block, order)[0], return_counts=True)
        merged, back = np.unique(np.concatenate([keys, found]), return_inverse=True)
        return merged, np.bincount(
            back, np.concatenate([counts, number]), len(merged)).astype(np.int64)

    block, size = [], 0
    for text in texts:
        block.append(text)
        size += len(text)
        if size >= SORTED_BYTES:
            keys, counts = add(block)
            block, size = [], 0
    return add(block) if block else (keys, counts)


def packed(numbers: np.ndarray) -> bytes:
    """64-bit numbers by places of their bytes, compressed: equal neighbours cost little."""
    import zstandard
    octets = np.ascontiguousarray(numbers, np.int64).view(np.uint8).reshape(-1, 8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(octets.T).tobytes())


def unpacked(octets: bytes) -> np.ndarray:
    import zstandard
    places = np.frombuffer(zstandard.ZstdDecompressor().decompress(octets), np.uint8)
    return np.ascontiguousarray(places.reshape(8, -1).T).reshape(-1).view(np.int64)


def frozen(frame: pd.DataFrame) -> bytes:
    """A small table as compressed Arrow data."""
    table = pa.Table.from_pandas(frame, preserve_index=False)
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
    with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def thawed(octets: bytes) -> pa.Table:
    return pa.ipc.open_stream(octets).read_all()


def packed_words(counts: dict[bytes, int]) -> tuple[bytes, bytes]:
    """Words and their numbers; no word holds a space."""
    import zstandard
    words = sorted(counts)
    return (zstandard.ZstdCompressor(level=1).compress(b" ".join(words)),
            packed(np.array([counts[word] for word in words], np.int64)))


def unpacked_words(octets: bytes) -> list[bytes]:
    import zstandard
    return zstandard.ZstdDecompressor().decompress(octets).split(b" ")


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, sorted, and the sums of their counts."""
    merged, back = np.unique(keys, return_inverse=True)
    # Below 2**53 the sums are exact.
    return merged, np.bincount(back, counts, len(merged)).astype(np.int64)


def dealt(keys: np.ndarray, counts: np.ndarray, parts: int) -> list[tuple[int, bytes, bytes]]:
    """Part, packed grams and packed counts. Grams of equal ``SHORT + 1`` last context
    bytes are in one part, side by side."""
    context = (keys >> 8) & ((1 << 8 * (SHORT + 1)) - 1)
    part = ((context * 0x9E3779B1 & 0xFFFFFFFF) >> 8) % parts
    order = np.lexsort((keys, context, part))
    keys, counts, part = keys[order], counts[order], part[order]
    first = np.flatnonzero(np.diff(part, prepend=-1))
    return [(int(part[a]), packed(keys[a:b]), packed(counts[a:b]))
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(keys)], strict=True)]


def chunked(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, order: int = ORDER,
            folds: int = FOLDS, parts: int = PARTS) -> DataFrame:
    """Documents in chunks, and the words and grams that each chunk uses.

    One table: rows with ``documents`` hold documents, those with ``low`` a gram of short
    context and its number ``n``; rows with ``words`` or ``grams`` hold those of a part and,
    in ``counts``, their numbers. All numbers are those in training documents.
    """
    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, number, size = TaskContext.get().partitionId(), 0, 0
        held: list[pd.DataFrame] = []

        def closed() -> Iterator[pd.DataFrame]:
            nonlocal number, size
            chunk = (task << 24) + number
            rows = pd.concat(held)
            held.clear()
            number, size = number + 1, 0
            yield _rows(chunk, 1, documents=[frozen(rows.astype({"doc_id": "Int64"}))])
            train = rows.loc[~rows["held_out"], "tokens"]
            other = rows.loc[rows["held_out"], "tokens"]
            counts: Counter[bytes] = Counter({END_WORD: len(train)})
            for text in train:
                counts.update(text.encode().split())
            for text in other:
                for word in text.encode().split():
                    counts.setdefault(word, 0)
            of_part: dict[int, dict[bytes, int]] = {}
            for word, n in counts.items():
                of_part.setdefault(crc32(word) % parts, {})[word] = n
            for name, some in of_part.items():
                words, numbers = packed_words(some)
                yield _rows(chunk, 1, part=[name], words=[words], counts=[numbers])
            seen, number_of = counted_grams(train, order)
            low, n = _summed(seen & ((1 << 8 * (SHORT + 1)) - 1), number_of)
            if len(low):
                yield _rows(chunk, len(low), low=low, n=n)
            unseen = np.setdiff1d(counted_grams(other, order)[0], seen, assume_unique=True)
            found = dealt(np.concatenate([seen, unseen]),
                          np.concatenate([number_of, np.zeros(len(unseen), np.int64)]), parts)
            for name, grams_of, counts_of in found:
                yield _rows(chunk, 1, part=[name], grams=[grams_of], counts=[counts_of])

        for frame in frames:
            frame = frame.assign(tokens=frame["text"].map(tokens_of)).drop(columns="text")
            sizes = frame["tokens"].str.len().to_numpy()
            first = 0
            for at, one in enumerate(sizes.tolist()):
                size += one
                if size >= chunk_bytes:
                    held.append(frame.iloc[first:at + 1])
                    first = at + 1
                    yield from closed()
            if first < len(frame):
                held.append(frame.iloc[first:])
        if held:
            yield from closed()

    rows = docs.select("doc_id", (fold(F.col("doc_id"), folds) == 0).alias("held_out"),
                       F.coalesce("text", F.lit("")).alias("text")).mapInPandas(cut, CHUNKS)
    path = scratch_path(docs.sparkSession, "chunks")
    rows.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(CHUNKS).parquet(path)


_TYPES = {"LONG": "Int64", "INT": "Int32"}


def _rows(chunk: int, size: int, **columns) -> pd.DataFrame:
    """Rows of a chunk with the given columns; the others are null."""
    rows = {"chunk": [chunk] * size}
    for name, kind in (column.split() for column in CHUNKS.split(", ")[1:]):
        given = columns.get(name, [None] * size)
        rows[name] = pd.array(given, _TYPES[kind]) if kind in _TYPES else list(given)
    return pd.DataFrame(rows)


def _at(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in sorted ``keys``, and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Level:
    """All contexts of one length: what followed how often.

    ``total`` and ``kinds`` are the number of bytes and of different bytes.
    ``below`` is the number of occurrences, in the next shorter context, of the
    bytes that this context has seen: what an escape from it excludes there.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        seen = counts > 0
        self.keys, self.counts = keys[seen], counts[seen]
        self.contexts, first = np.unique(self.keys >> 8, return_index=True)
        self.total = (np.add.reduceat(self.counts, first) if len(first)
                      else np.empty(0, np.int64))
        self.kinds = np.diff(np.append(first, len(self.keys)))
        self.first = first
        self.below = np.zeros(len(first), np.int64)

    def shortened(self, order: int) -> Level:
        mask = (1 << (8 * order)) - 1
        keys, back = np.unique(self.keys & mask, return_inverse=True)
        return Level(keys, np.bincount(back, self.counts, len(keys)).astype(np.int64))

    def link(self, shorter: Level, order: int) -> None:
        if len(self.keys):
            at, there = _at(shorter.keys, self.keys & ((1 << (8 * order)) - 1))
            self.below = np.add.reduceat(np.where(there, shorter.counts[at], 0), self.first)


def levels(keys: np.ndarray, counts: np.ndarray, longest: int, shortest: int,
           short: list[Level]) -> list[Level]:
    """Levels from ``longest`` down to ``shortest``, continued by given short ones."""
    made = [Level(keys, counts)]
    for order in range(longest, shortest, -1):
        made.append(made[-1].shortened(order))
    made += short
    for i, (level, below) in enumerate(zip(made, made[1:], strict=False)):
        level.link(below, longest - i)
    return made


def code_lengths(keys: np.ndarray, trie: list[Level], order: int = ORDER) -> np.ndarray:
    """Log10 probability of the last byte of every key in the context before it."""
    result = np.zeros(len(keys))
    active = np.arange(len(keys))
    # What the longer context excludes here: bytes, and different bytes.
    total_out, kinds_out = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    for i, level in enumerate(trie):
        if not len(active):
            break
        wanted = keys[active] & ((1 << (8 * (order - i + 1))) - 1)
        at, there = _at(level.contexts, wanted >> 8)
        if not there.any():
            continue
        active_here, at, wanted = active[there], at[there], wanted[there]
        total = level.total[at] - total_out[active_here]
        kinds = level.kinds[at] - kinds_out[active_here]
        whole = np.maximum(total + kinds, 1)
        symbol, found = _at(level.keys, wanted)
        result[active_here[found]] += np.log10(level.counts[symbol[found]] / whole[found])
        lost = ~found
        escape = lost & (kinds > 0)
        result[active_here[escape]] += np.log10(kinds[escape] / whole[escape])
        total_out[active_here[lost]] = level.below[at[lost]]
        kinds_out[active_here[lost]] = level.kinds[at[lost]]
        active = np.setdiff1d(active, active_here[found], assume_unique=True)
    if len(active):
        left = SYMBOLS - (trie[-1].kinds[0] if len(trie[-1].kinds) else 0)
        result[active] -= np.log10(left)
    return result


def _values(table: DataFrame, order: int = ORDER) -> DataFrame:
    """The grams of every chunk with their codes, in packed rows; see VALUES.

    The value of a gram is ``table[code]``. Codes are computed where all grams of equal
    ``SHORT + 1`` last context bytes are.
    """
    spark = table.sparkSession
    low = (table.filter("low IS NOT NULL").groupBy("low").agg(F.sum("n").alias("n"))
           .filter("n > 0").collect())
    low_keys = np.array(sorted(row["low"] for row in low), np.int64)
    by_key = {row["low"]: row["n"] for row in low}
    low_counts = np.array([by_key[key] for key in low_keys.tolist()], np.int64)
    short = levels(low_keys, low_counts, SHORT, 0, [])

    def summed(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        held, size = [], 0
        for at in range(len(rows)):
            held.append((unpacked(rows["grams"].iat[at]), unpacked(rows["counts"].iat[at])))
            size += len(held[-1][0])
            if size >= SUMMED or at == len(rows) - 1:
                more, number = zip(*held, strict=True)
                keys, counts = _summed(np.concatenate([keys, *more]),
                                       np.concatenate([counts, *number]))
                held, size = [], 0
        return keys, counts

    def coded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = list(frames)
        if not sum(map(len, held)):
            return
        rows = pd.concat(held, ignore_index=True)
        keys, counts = summed(rows)
        values = code_lengths(keys, levels(keys, counts, order, SHORT + 1, short), order)
        for chunk, own in rows.groupby("chunk"):
            wanted = np.concatenate([unpacked(grams_of) for grams_of in own["grams"]])
            different, codes = np.unique(values[np.searchsorted(keys, wanted)],
                                         return_inverse=True)
            yield pd.DataFrame({"chunk": [chunk], "grams": [packed(wanted)],
                                "codes": [packed(codes)], "table": [different.tobytes()]})

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return table.filter("grams IS NOT NULL").select("part", "chunk", "grams", "counts").repartition(
        parts, "part").mapInPandas(coded, VALUES)


def _counted_words(table: DataFrame) -> DataFrame:
    """The words of every chunk with their numbers in all chunks, in packed rows, and rows
    without a chunk with the sum of numbers and the number of known words; see WORDS."""
    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = list(frames)
        if not sum(map(len, held)):
            return
        rows = pd.concat(held, ignore_index=True)
        counts: dict[bytes, int] = {}
        for words, numbers in zip(rows["words"], rows["counts"], strict=True):
            for word, n in zip(unpacked_words(words), unpacked(numbers).tolist(), strict=True):
                counts[word] = counts.get(word, 0) + n
        for chunk, words in zip(rows["chunk"], rows["words"], strict=True):
            numbers = np.array([counts[word] for word in unpacked_words(words)], np.int64)
            yield pd.DataFrame({"chunk": [chunk], "words": [words], "counts": [packed(numbers)],
                                "total": pd.array([None], "Int64"),
                                "kinds": pd.array([None], "Int64")})
        yield pd.DataFrame({"chunk": pd.array([None], "Int64"), "words": [None], "counts": [None],
                            "total": [sum(counts.values())],
                            "kinds": [sum(n > 0 for n in counts.values())]})

    parts = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return table.filter("words IS NOT NULL").select("part", "chunk", "words", "counts").repartition(
        parts, "part").mapInPandas(counted, WORDS)


def _score(rows: pd.DataFrame, order: int, train_tokens: int, vocabulary: int,
           smoothing: float) -> pd.DataFrame:
    """Scores of the documents of one chunk."""
    counts: dict[bytes, int] = {}
    for words, numbers in rows.loc[rows["words"].notna(), ["words", "counts"]].itertuples(False):
        counts.update(zip(unpacked_words(words), unpacked(numbers).tolist(), strict=True))
    coded = rows[rows["grams"].notna()]
    keys = np.concatenate([np.empty(0, np.int64), *map(unpacked, coded["grams"])])
    values = np.concatenate([np.empty(0), *(
        np.frombuffer(table)[unpacked(codes)]
        for codes, table in zip(coded["codes"], coded["table"], strict=True))])
    sorting = np.argsort(keys)
    keys, values = keys[sorting], values[sorting]
    whole = train_tokens + smoothing * (vocabulary + 1)

    def scored(block: pa.Table) -> pd.DataFrame:
        texts = block["tokens"].to_pylist()
        wanted, sizes = grams(texts, order)
        # Sorted, neighbours are found side by side.
        sorting = np.argsort(wanted)
        lengths = np.empty(len(wanted))
        lengths[sorting] = values[np.searchsorted(keys, wanted[sorting])]
        words = [[counts[word] for word in text.encode().split()] + [counts[END_WORD]]
                 for text in texts]
        n_tokens = np.array([len(found) for found in words], np.int64)
        number = np.fromiter(chain.from_iterable(words), np.int64, n_tokens.sum())
        first, first_word = np.cumsum(sizes) - sizes, np.cumsum(n_tokens) - n_tokens
        return pd.DataFrame({
            "doc_id": block["doc_id"].to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get),
            "held_out": block["held_out"].to_pandas(), "n_tokens": n_tokens,
            "n_known": np.add.reduceat((number > 0).astype(np.int64), first_word),
            "train_tokens": train_tokens,
            "base_score": np.add.reduceat(np.log10((number + smoothing) / whole), first_word),
            "score": np.add.reduceat(lengths, first)})

    documents = pa.concat_tables([thawed(octets) for octets in rows["documents"].dropna()])
    sizes = np.cumsum([len(text) for text in documents["tokens"].to_pylist()])
    found, at = [], 0
    while at < len(documents):
        before = sizes[at - 1] if at else 0
        until = max(at + 1, int(np.searchsorted(sizes, before + SORTED_BYTES // 4)))
        found.append(scored(documents.slice(at, until - at)))
        at = until
    return pd.concat(found)


def score(docs: DataFrame, order: int = ORDER, folds: int = FOLDS,
          chunk_bytes: int = CHUNK_BYTES, smoothing: float = SMOOTHING) -> DataFrame:
    """Scores of all documents; see SCORES for the columns."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = chunked(docs, chunk_bytes, order, folds, PARTS * partitions)

    def kept(frame: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        frame.write.parquet(path)
        # Spark drops the shuffle files of a finished step only with the garbage of the
        # driver, which may come after the disks are full.
        spark.sparkContext._jvm.System.gc()
        return spark.read.schema(frame.schema).parquet(path)

    words = kept(_counted_words(table), "words")
    values = kept(_values(table, order), "values")
    total = words.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("tokens"),
                      F.coalesce(F.sum("kinds"), F.lit(0)).alias("kinds")).first()
    scored = partial(_score, order=order, train_tokens=total["tokens"], vocabulary=total["kinds"],
                     smoothing=smoothing)

    def together(rows: pd.DataFrame) -> pd.DataFrame:
        return scored(rows)

    documents = table.filter("documents IS NOT NULL").select("chunk", "documents")
    used = documents.unionByName(
        words.filter("words IS NOT NULL").select("chunk", "words", "counts"),
        allowMissingColumns=True).unionByName(values, allowMissingColumns=True)
    return used.groupBy("chunk").applyInPandas(together, SCORES)
