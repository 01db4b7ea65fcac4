"""quayside: journal ingestion on Spark.

Landed files → manifest → delimited reader → mapping → flag/split → keyed
writes into versioned tables, in batch or on a stream.  The public API:
"""

from .operators.mapping import (drop_audit, fill_missing_required, fill_sentinel, incremental_window, map_lenient,
                                map_strict, missing_columns)
from .operators.merge import dedupe_last, replace_by_key, upsert
from .operators.split import count_flagged, flag_repeated, split_counts, split_repeated
from .plans.flows import run_claims, run_journal, run_routed_claims
from .sinks.files import archive_files, retire_files
from .sinks.report import load_report
from .sinks.snapshot import VersionedTable, publish_snapshot
from .sources.catalog import table_columns, table_health
from .sources.delimited import decode_charset, null_tokens, read_delimited, read_delimited_split
from .sources.files import (classify_files, discover_files, latest_by_name, latest_by_time, plan_file_actions,
                            route_files)
from .spec import TableSpec, load_specs
from .streaming.ingest import run_once, stream_journal, stream_upsert

__all__ = [
    "TableSpec", "VersionedTable", "archive_files", "classify_files", "count_flagged", "decode_charset",
    "dedupe_last", "discover_files", "drop_audit", "fill_missing_required", "fill_sentinel", "flag_repeated",
    "incremental_window", "latest_by_name", "latest_by_time", "load_report", "load_specs", "map_lenient",
    "map_strict", "missing_columns", "null_tokens", "plan_file_actions", "publish_snapshot", "read_delimited",
    "read_delimited_split", "replace_by_key", "retire_files", "route_files", "run_claims", "run_journal",
    "run_once", "run_routed_claims", "split_counts", "split_repeated", "stream_journal", "stream_upsert",
    "table_columns", "table_health", "upsert",
]
