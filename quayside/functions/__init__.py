"""Column-level helpers (all native Spark expressions)."""

from .charsets import decode_column, decode_text, encode_column, encode_text, needs_translation
from .columns import all_not_null, any_null, qcol, require_columns
from .globs import glob_match, glob_to_regex
from .tokens import AUDIT_COLUMNS, PANDAS_NULL_TOKENS, SENTINEL

__all__ = [
    "AUDIT_COLUMNS", "PANDAS_NULL_TOKENS", "SENTINEL", "all_not_null", "any_null",
    "decode_column", "decode_text", "encode_column", "encode_text", "glob_match",
    "glob_to_regex", "needs_translation", "qcol", "require_columns",
]
