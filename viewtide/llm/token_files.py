"""Token ids in binary files, each document compressed apart with one dictionary.

A folder holds ``dictionary.zdict``, files ``shard-00000.tok`` and a table
``manifest`` with one row per file. A file starts with a magic word, the type of
an id and the SHA-256 of the dictionary; then one zstandard frame per document;
then an index of one entry per document (id, offset and size of its frame,
tokens) and the place of that index. One document is read with two short reads.

Documents are in ascending order of id, nulls first; files follow each other in
that order. Rows of equal id are ordered by the hash of their text. Null texts
are empty documents, which hold only the end id; an empty table gives a folder
without files. Files are written under a passing name and renamed when they are
whole, so a task that is run again replaces its own file and nothing else.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from viewtide.llm.tokens import encoder, widened

MAGIC = b"VTIDS001"
INDEX = np.dtype([("known", "u1"), ("doc_id", "<i8"), ("offset", "<u8"), ("size", "<u4"),
                  ("tokens", "<u8")])
_HEAD = "<8s4s32s"
_TAIL = "<QQ8s"

# What the dictionary is fitted on: so many documents, those whose hashed ids
# are smallest, in blocks of so many bytes, and so many blocks in all.
SAMPLE_DOCS = 1000
SAMPLE_BLOCK = 8192
SAMPLE_BLOCKS = 1500
DICTIONARY_BYTES = 65536
LEVEL = 3
BATCH = 128

MANIFEST = "shard INT, path STRING, docs LONG, tokens LONG, first_id LONG, last_id LONG"
DOCUMENT = "doc_id LONG, start LONG, n_tokens LONG, ids BINARY"


def _place(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and inner path of a folder that all executors share."""
    return pyarrow.fs.FileSystem.from_uri(path)


def _dictionary(data: bytes):
    import zstandard
    return zstandard.ZstdCompressionDict(data) if data else None


def train_dictionary(docs: DataFrame, path: str, sample_docs: int = SAMPLE_DOCS,
                     dictionary_bytes: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary from the id arrays of a bounded sample.

    The sample comes to the driver: at most SAMPLE_BLOCKS blocks of
    SAMPLE_BLOCK bytes. Too little data to train on is used as it is.
    """
    import zstandard

    def blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = encoder(path)
        for frame in frames:
            data = [ids[at:at + SAMPLE_BLOCK] for ids in code.encode(frame["text"].tolist())
                    for at in range(0, len(ids), SAMPLE_BLOCK)]
            yield pd.DataFrame({"block": data})

    chosen = (docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
              .distinct())
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(chosen), "doc_id", "left_semi")
    rows = (texts.mapInPandas(blocks, "block BINARY").orderBy(F.xxhash64("block"), "block")
            .limit(SAMPLE_BLOCKS).collect())
    samples = [bytes(row["block"]) for row in rows]
    try:
        return zstandard.train_dictionary(dictionary_bytes, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-dictionary_bytes:]


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int,
                      partitions: int | None = None, level: int = LEVEL) -> DataFrame:
    """Writes the folder and returns its manifest.

    ``partitions`` is the number of files, by default the shuffle partitions of
    the session; their ranges of ids are of about equal size.
    """
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dictionary = train_dictionary(docs, path)
    digest = hashlib.sha256(dictionary).digest()
    files, inner = _place(folder)
    files.create_dir(inner, recursive=True)
    with files.open_output_stream(f"{inner}/dictionary.zdict") as out:
        out.write(dictionary)

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        code = encoder(path)
        end = np.array([end_id], code.dtype).tobytes()
        shrink = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(dictionary))
        shard = TaskContext.get().partitionId()
        files, inner = _place(folder)
        passing = f"{inner}/.shard-{shard:05d}-{uuid.uuid4().hex}"
        index: list[tuple] = []
        out, offset = None, struct.calcsize(_HEAD)
        for frame in frames:
            for at in range(0, len(frame), BATCH):
                part = frame.iloc[at:at + BATCH]
                if out is None:
                    out = files.open_output_stream(passing)
                    out.write(struct.pack(_HEAD, MAGIC, code.dtype.str.encode(), digest))
                for doc_id, ids in zip(part["doc_id"], code.encode(part["text"].tolist()),
                                       strict=True):
                    data = ids + end
                    packed = shrink.compress(data)
                    known = not pd.isna(doc_id)
                    index.append((known, int(doc_id) if known else 0, offset, len(packed),
                                  len(data) // code.dtype.itemsize))
                    out.write(packed)
                    offset += len(packed)
        if out is None:
            return
        entries = np.array(index, INDEX)
        out.write(entries.tobytes())
        out.write(struct.pack(_TAIL, offset, len(entries), MAGIC))
        out.close()
        name = f"shard-{shard:05d}.tok"
        files.move(passing, f"{inner}/{name}")
        ids = entries["doc_id"][entries["known"] == 1]
        yield pd.DataFrame({
            "shard": [shard], "path": [f"{folder}/{name}"], "docs": [len(entries)],
            "tokens": [int(entries["tokens"].sum())],
            "first_id": pd.array([int(ids[0]) if len(ids) else None], "Int64"),
            "last_id": pd.array([int(ids[-1]) if len(ids) else None], "Int64")})

    text = F.coalesce("text", F.lit("")).alias("text")
    order = [F.col("doc_id"), F.xxhash64("text")]
    ordered = (docs.select("doc_id", text).repartitionByRange(partitions, *order)
               .sortWithinPartitions(*order))
    ordered.mapInPandas(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files in order, with the number of tokens before each in ``before``.

    One row per file goes through the window.
    """
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").withColumn(
        "before", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))


def _head(source, dictionary: bytes) -> np.dtype:
    magic, kind, digest = struct.unpack(_HEAD, source.read_at(struct.calcsize(_HEAD), 0))
    if magic != MAGIC or digest != hashlib.sha256(dictionary).digest():
        raise ValueError("not a token file, or written with another dictionary")
    return np.dtype(kind.rstrip(b"\0").decode())


def _index(source) -> np.ndarray:
    at, count, magic = struct.unpack(_TAIL, source.read_at(struct.calcsize(_TAIL), source.size() - struct.calcsize(_TAIL)))
    if magic != MAGIC:
        raise ValueError("a token file without its end")
    return np.frombuffer(source.read_at(count * INDEX.itemsize, at), INDEX)


def _folder_dictionary(folder: str) -> bytes:
    files, inner = _place(folder)
    with files.open_input_file(f"{inner}/dictionary.zdict") as source:
        return source.read()


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents ``doc_id, start, n_tokens, ids`` of a folder.

    ``start`` counts the tokens of all documents before; ``ids`` are
    little-endian unsigned 32-bit integers.
    """
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        dictionary = None
        for frame in frames:
            for path, before in zip(frame["path"], frame["before"], strict=True):
                dictionary = _folder_dictionary(folder) if dictionary is None else dictionary
                expand = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
                files, inner = _place(path)
                with files.open_input_file(inner) as source:
                    dtype, index = _head(source, dictionary), _index(source)
                    starts = before + np.cumsum(index["tokens"].astype("i8")) - index["tokens"]
                    for at in range(0, len(index), BATCH):
                        part = index[at:at + BATCH]
                        first, last = int(part["offset"][0]), int(part["offset"][-1])
                        data = source.read_at(last + int(part["size"][-1]) - first, first)
                        ids = [widened(expand.decompress(data[o:o + s]), dtype) for o, s in
                               zip((part["offset"] - first).tolist(), part["size"].tolist(),
                                   strict=True)]
                        yield pd.DataFrame({
                            "doc_id": pd.array(part["doc_id"], "Int64").copy(),
                            "start": starts[at:at + BATCH].astype("i8"),
                            "n_tokens": part["tokens"].astype("i8"), "ids": ids,
                        }).assign(doc_id=lambda rows, known=part["known"]:
                                  rows["doc_id"].where(known == 1))

    manifest = read_manifest(spark, folder).select("path", "before")
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(files, "path").mapInPandas(read, DOCUMENT)


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[np.ndarray]:
    """Ids of the documents of one id: the index of their file and their frames."""
    import zstandard
    dictionary = _folder_dictionary(folder)
    expand = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
    found = []
    for row in read_manifest(spark, folder).filter(
            F.lit(doc_id).between(F.col("first_id"), F.col("last_id"))).orderBy("shard").collect():
        files, inner = _place(row["path"])
        with files.open_input_file(inner) as source:
            dtype, index = _head(source, dictionary), _index(source)
            for entry in index[(index["known"] == 1) & (index["doc_id"] == doc_id)]:
                frame = source.read_at(int(entry["size"]), int(entry["offset"]))
                found.append(np.frombuffer(expand.decompress(frame), dtype))
    return found
