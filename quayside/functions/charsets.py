"""Single-byte code pages the CSV reader of Spark does not accept.

Spark 4.1 rejects ``cp1251`` as a CSV charset.  A single-byte code page is a
character-for-character substitution of ISO-8859-1, so we read the bytes as
``iso-8859-1`` and apply one native ``translate`` per column: no Python in
the data path.  The 128-entry upper half is built from Python's own codec
(a rule, not a hand-written table).  A byte the code page leaves undefined
(0x98 in cp1251) maps to U+FFFD, as a Java decoder would.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

NATIVE_CHARSETS = {"utf-8", "utf8", "utf-16", "utf-16le", "utf-16be", "utf-32", "us-ascii",
                   "ascii", "iso-8859-1", "latin1", "latin-1"}
REPLACEMENT = "�"


def normalise(encoding: str | None) -> str:
    return (encoding or "utf-8").strip().lower().replace("_", "-")


def needs_translation(encoding: str | None) -> bool:
    return normalise(encoding) not in NATIVE_CHARSETS


@lru_cache(maxsize=None)
def upper_half(encoding: str) -> tuple[str, str]:
    """(latin-1 characters 0x80-0xFF, the characters ``encoding`` gives them)."""
    src = "".join(chr(b) for b in range(0x80, 0x100))
    dst = "".join(bytes([b]).decode(normalise(encoding), errors="replace") for b in range(0x80, 0x100))
    if len(dst) != 128:
        raise ValueError(f"{encoding} is not a single-byte code page")
    return src, dst


def decode_column(col: Column | str, encoding: str) -> Column:
    """Text read as iso-8859-1 → the text the bytes mean in ``encoding``."""
    c = F.col(col) if isinstance(col, str) else col
    src, dst = upper_half(encoding)
    return F.translate(c, src, dst)


def decode_text(text: str, encoding: str) -> str:
    """Driver-side twin of :func:`decode_column`, for header names."""
    src, dst = upper_half(encoding)
    return text.translate(str.maketrans(src, dst))


def encode_column(col: Column | str, encoding: str) -> Column:
    """Inverse of :func:`decode_column`: text → characters whose latin-1 bytes
    are the ``encoding`` bytes.  Used to land code-page files from Spark."""
    c = F.col(col) if isinstance(col, str) else col
    src, dst = upper_half(encoding)
    keep = [(d, s) for s, d in zip(src, dst) if d != REPLACEMENT]
    return F.translate(c, "".join(d for d, _ in keep), "".join(s for _, s in keep))


def encode_text(text: str, encoding: str) -> str:
    src, dst = upper_half(encoding)
    keep = {ord(d): s for s, d in zip(src, dst) if d != REPLACEMENT}
    return text.translate(keep)
