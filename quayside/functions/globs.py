"""Shell-style file-name patterns as Spark column predicates.

Semantics are those of POSIX ``fnmatch``: ``*`` any run, ``?`` one character,
``[abc]`` / ``[a-z]`` a set, ``[!abc]`` a negated set; case-sensitive; the whole
name must match.  The pattern becomes an anchored Java regex evaluated by
``rlike`` inside the JVM (no Python per row).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def glob_to_regex(pattern: str) -> str:
    out = ["^"]
    i, n = 0, len(pattern)
    while i < n:
        c = pattern[i]
        i += 1
        if c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif c == "[":
            j = i
            if j < n and pattern[j] == "!":
                j += 1
            if j < n and pattern[j] == "]":
                j += 1
            while j < n and pattern[j] != "]":
                j += 1
            if j >= n:
                out.append(re.escape("["))
                continue
            body = pattern[i:j]
            i = j + 1
            negate = body.startswith("!")
            if negate:
                body = body[1:]
            body = body.replace("\\", "\\\\").replace("[", "\\[").replace("&&", "\\&\\&")
            if body.startswith("^"):
                body = "\\" + body
            out.append("[" + ("^" if negate else "") + body + "]")
        else:
            out.append(_java_quote(c))
    out.append("\\z")
    return "(?s)" + "".join(out)


def _java_quote(ch: str) -> str:
    return "\\" + ch if ch in r".^$|?*+()[]{}\/-" else ch


def glob_match(col: Column | str, pattern: str) -> Column:
    """Boolean column: ``col`` matches the shell pattern ``pattern``."""
    c = F.col(col) if isinstance(col, str) else col
    return c.rlike(glob_to_regex(pattern))
