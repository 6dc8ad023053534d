"""Writers and load results."""
from viewtide.parts import drop_old_versions, read_parts, replace_parts
from viewtide.sinks.serving import (
    latest_docs,
    load_report,
    publish_docs,
    read_document,
    read_serving,
    upsert_docs,
)
from viewtide.sinks.tables import (
    overwrite_year,
    read_years,
    series_part,
    write_bucketed_facts,
    write_facts,
    write_master,
    write_rejects,
    write_series,
    write_top_pages,
)
from viewtide.sinks.text import (
    doc_lines,
    export_compressed,
    write_doc_lines,
    write_stage_kv,
    write_stamped_lines,
)

__all__ = [
    "doc_lines", "drop_old_versions", "export_compressed", "latest_docs", "load_report",
    "overwrite_year", "publish_docs", "read_document", "read_parts", "read_serving",
    "read_years", "replace_parts", "series_part", "upsert_docs", "write_bucketed_facts",
    "write_doc_lines", "write_facts", "write_master", "write_rejects", "write_series", "write_stage_kv",
    "write_stamped_lines", "write_top_pages",
]
