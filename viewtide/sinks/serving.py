"""Documents loaded by id into a keyed table, and the report of a load.

Load order is file path, then line: a later document replaces an earlier one
with the same id. Everything per id is an aggregate with a partial step, so
many copies of one id are reduced before the shuffle.

The stored table lies in hash buckets of its key. A load rewrites the buckets in
which its keys fall and leaves the files of all others in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide.operators.documents import with_validity
from viewtide.parts import State, read_parts, replace_parts, state_of
from viewtide.storage import scratch_path

_LOAD_ORDER = ("file_path", "block_start", "line_id")
_DOC_SCHEMA = "grain STRING, doc_id STRING, doc STRING"
# A weekly and a daily document may have the same id: the grain is part of the key.
KEY = ("grain", "doc_id")
# Buckets of a new serving table. A load reads and writes whole buckets, each in one
# task; choose so many that one holds a few hundred megabytes when the table is full.
BUCKETS = 64


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents without a grain form one of their own, ''."""
    return docs if "grain" in docs.columns else docs.withColumn("grain", F.lit(""))


def latest_docs(incoming: DataFrame) -> DataFrame:
    """The last document of every key in load order: ``grain, doc_id, doc``."""
    last = F.max_by("doc", F.struct(*_LOAD_ORDER)).alias("doc")
    return _keyed(incoming).groupBy(*KEY).agg(last)


def upsert_docs(existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """Existing documents, replaced or extended by the incoming ones."""
    latest = latest_docs(incoming)
    if existing is None:
        return latest
    kept = _keyed(existing).select(*KEY, "doc").join(latest, list(KEY), "left_anti")
    return kept.unionByName(latest)


def _bucket(buckets: int) -> Column:
    """Name of a key's bucket; it also tells into how many the table was divided."""
    number = F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("string")
    return F.concat(F.lpad(number, len(str(buckets)), "0"), F.lit(f"-of-{buckets}"))


def _divided(state: State) -> int | None:
    """Into how many buckets a table is divided, ``None`` before the first load."""
    return next((int(name.rpartition("-")[2]) for name in state.folders), None)


def publish_docs(incoming: DataFrame, path: str, buckets: int = BUCKETS) -> list[str]:
    """Upserts into the serving table at ``path``; returns the buckets rewritten.

    ``buckets`` divides a new table; later loads keep its division. The incoming
    documents are reduced to the last of every key and written once; only stored
    buckets that get one of these keys are read, merged and written. Rows of a bucket
    are brought together in a single shuffle that also serves the merge.
    """
    spark = incoming.sparkSession
    state = state_of(spark, path)
    divided = _divided(state) or buckets
    staged = scratch_path(spark, "incoming")
    latest = latest_docs(incoming).withColumn("bucket", _bucket(divided))
    latest.write.parquet(staged)
    latest = spark.read.schema(latest.schema).parquet(staged)
    touched = sorted(row["bucket"] for row in latest.select("bucket").distinct().collect())
    if not touched and state.version is not None:
        return []
    existing = read_parts(spark, path, _DOC_SCHEMA, touched, state=state).withColumn(
        "bucket", _bucket(divided))
    newer = F.max_by("doc", "new").alias("doc")
    merged = (existing.withColumn("new", F.lit(0)).unionByName(latest.withColumn("new", F.lit(1)))
              .repartition(max(1, len(touched)), "bucket").groupBy("bucket", *KEY).agg(newer))
    return replace_parts(merged, "bucket", path, arranged=True, sort=KEY, state=state)


def read_serving(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Documents of the current version: ``grain, doc_id, doc``."""
    state = state_of(spark, path, version)
    if state.version is None:
        raise FileNotFoundError(f"nothing published at {path}")
    return read_parts(spark, path, _DOC_SCHEMA, state=state)


def read_document(spark: SparkSession, path: str, grain: str, doc_id: str) -> DataFrame:
    """One document by its key: only the key's bucket is opened, and within its files
    the row groups that may hold the key."""
    state = state_of(spark, path)
    divided = _divided(state)
    key = spark.range(1).select(F.lit(grain).alias("grain"), F.lit(doc_id).alias("doc_id"))
    name = [] if divided is None else [key.select(_bucket(divided)).first()[0]]
    return read_parts(spark, path, _DOC_SCHEMA, name, state=state).filter(
        (F.col("grain") == grain) & (F.col("doc_id") == doc_id))


def load_report(lines: DataFrame, existing: DataFrame | None = None,
                by: Sequence[str] = ("file_path",)) -> DataFrame:
    """Per file: lines, blank, invalid and loaded, and of the loaded documents
    how many created an id and how many updated one.

    A document creates its id when the id is not in ``existing`` and no earlier
    loaded document has it. ``by`` may name other columns that follow from the
    file path.
    """
    judged = with_validity(_keyed(lines)).withColumn("blank", F.col("value") == "")
    loaded = ~F.col("blank") & F.col("valid")
    counts = judged.groupBy(*by).agg(
        F.count("*").alias("lines"), F.count_if("blank").alias("blank"),
        F.count_if(~F.col("blank") & ~F.col("valid")).alias("invalid"),
        F.count_if(loaded).alias("loaded"))
    first = (judged.filter(loaded).groupBy(*KEY)
             .agg(F.min(F.struct(*_LOAD_ORDER, F.struct(*by).alias("file"))).alias("first")))
    if existing is not None:
        first = first.join(_keyed(existing).select(*KEY), list(KEY), "left_anti")
    created = (first.groupBy(*[F.col(f"first.file.{name}").alias(name) for name in by])
               .agg(F.count("*").alias("created")))
    made = F.coalesce("created", F.lit(0))
    return counts.join(created, list(by), "left").select(
        *by, "lines", "blank", "invalid", "loaded", made.alias("created"),
        (F.col("loaded") - made).alias("updated"))
