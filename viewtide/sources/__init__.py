"""Readers."""
from viewtide.sources.hourly import (
    files_limit,
    keep_files,
    last_kept_names,
    limit_per_file,
    list_files,
    load_scope,
    sample_files,
    scan_lines,
    scope_paths,
    within_names,
)
from viewtide.sources.stored import (
    read_daily,
    read_doc_lines,
    read_master,
    read_rejects,
    read_series,
    read_stage_kv,
    read_top_list,
    read_top_pages,
)

__all__ = [
    "files_limit", "keep_files", "last_kept_names", "within_names", "limit_per_file",
    "list_files", "load_scope", "sample_files", "scan_lines", "scope_paths", "read_daily",
    "read_doc_lines", "read_master", "read_rejects", "read_series", "read_stage_kv",
    "read_top_list", "read_top_pages",
]
