"""From document lines to the serving table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viewtide.operators.documents import valid_json_docs, with_validity
from viewtide.sinks import load_report, publish_docs, read_serving
from viewtide.sources import read_doc_lines
from viewtide.storage import scratch_path


def load_documents(spark: SparkSession, source: str, serving: str) -> DataFrame:
    """Loads every valid document below ``source`` by key; returns the report.

    The text is read and its JSON parsed once: the judged lines are kept in the
    shared folder, and the upsert and both parts of the report start there.
    """
    judged = with_validity(read_doc_lines(spark, source))
    path = scratch_path(spark, "judged")
    judged.write.parquet(path)
    lines = spark.read.schema(judged.schema).parquet(path)
    try:
        existing = read_serving(spark, serving)
    except FileNotFoundError:
        existing = None
    publish_docs(valid_json_docs(lines), serving)
    return load_report(lines, existing)
