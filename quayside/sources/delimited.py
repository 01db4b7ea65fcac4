"""Delimited text → all-string DataFrame (the file-reading half of a load).

Semantics follow a default pandas ``read_csv(dtype=str)`` of each landed file:

* every cell is text; header names come from the file, duplicates are named
  ``x, x.1, x.2`` and a UTF-8 byte-order mark is dropped;
* ``"`` quotes, doubled quotes inside quotes, delimiters and newlines inside
  quotes.  How a file is read follows from what stands in it, never from its
  size.  One splittable pass over the first and all other lines of the files
  (:func:`file_layouts`) finds their headers and their kind: where every line is
  a record by itself the file is read by lines; where a quoted cell goes on over
  a line end, records are put together first (:mod:`quayside.sources.records`),
  by as many tasks as the file has splits; a file with a lone carriage return, or
  in a code page of wide characters, is one task.  Only empty lines are no rows;
* a short row is padded with NULL; a *long* row (more fields than the header,
  empty ones too) is an error by default (``on_bad="error"``, raised by the scan
  itself, no extra pass) or set aside with its whole record
  (``on_bad="quarantine"``, see :func:`read_delimited_split`) — never silently
  truncated;
* empty cells stay ``""`` here; :func:`null_tokens` turns them (and the other
  pandas NA strings) into NULL;
* code pages Spark cannot decode (cp1251) are read as ISO-8859-1 and
  translated natively (:mod:`quayside.functions.charsets`).

Each row carries ``_pos`` = (file ordinal in apply order, split offset, row
id), captured at the scan before any shuffle, so "last row in file order
wins" survives any later repartitioning.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.charsets import REPLACEMENT, decode_column, needs_translation, normalise
from ..functions.columns import qcol
from ..functions.tokens import PANDAS_NULL_TOKENS, SOURCE_FILE
from .records import assembled, text_lines

EXTRA = "__qs_extra"
# The record as it stood, of a row that has not as many fields as the header.
RECORD = "_record"
POS = "_pos"
# Fixed value: a null marker no landed text contains, so that an empty cell
# reads as "" and a missing (short-row) cell as NULL.
NO_NULL_MARKER = "\u0000<no-null>\u0000"


#: Kinds of files: every line is a record, lines make records, one task.
LINES, RECORDS, WHOLE = "lines", "records", "whole"
UTF8 = ("utf-8", "utf8", "us-ascii", "ascii")
ASCII_COMPATIBLE = (*UTF8, "iso-8859-1", "latin1", "latin-1")


def _options(delimiter: str, encoding: str, multiline: bool) -> dict[str, str]:
    return {"sep": delimiter, "encoding": "iso-8859-1" if needs_translation(encoding) else normalise(encoding),
            "quote": '"', "escape": '"', "multiLine": str(bool(multiline)).lower(), "nullValue": NO_NULL_MARKER, "emptyValue": "",
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
            # a parser that skips columns does not see that a row has too many
            "columnPruning": "false",
            "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD}


def pandas_names(raw: Sequence[str]) -> list[str]:
    """Header names as pandas makes them unique: ``x, y, x.1``."""
    seen: dict[str, int] = {}
    used: set[str] = set()
    out = []
    for i, name in enumerate(raw):
        name = "" if name is None else str(name)
        if i == 0 and name.startswith("\ufeff"):
            name = name[1:]
        base = name if name != "" else f"Unnamed: {i}"
        cand = base
        if cand in used:
            k = seen.get(base, 0)
            while cand in used:
                k += 1
                cand = f"{base}.{k}"
            seen[base] = k
        used.add(cand)
        out.append(cand)
    return out


# A header longer than this is refused, never cut.
HEADER_LIMIT_BYTES = 64 << 20


def read_header(spark: SparkSession, path: str, delimiter: str = ",", encoding: str = "utf-8") -> list[str]:
    """The header of one file, parsed from its first bytes (read through the
    Hadoop file system on the driver: a metadata-sized read, no Spark job)."""
    from ..session import fs_for

    fs, jpath = fs_for(spark, path)
    stream = fs.open(jpath)
    try:
        buf = bytearray()
        seen = 0
        while True:
            chunk = bytes(stream.readNBytes(65536))   # a returned byte[] crosses as bytes
            if not chunk:
                break
            buf += chunk
            line_end = buf.find(b"\n", seen)
            while line_end >= 0 and buf[:line_end].count(b'"') % 2:
                line_end = buf.find(b"\n", line_end + 1)
            if line_end >= 0:
                break
            seen = buf.rfind(b"\n") + 1 if buf.count(b'"') % 2 == 0 else 0
            if len(buf) > HEADER_LIMIT_BYTES:
                raise ValueError(f"{path}: no header line ends within {HEADER_LIMIT_BYTES} bytes")
    finally:
        stream.close()
    if not buf:
        raise ValueError(f"{path}: no header line (empty file)")
    return header_names(bytes(buf), delimiter, encoding)


def _file_table(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(uri as the scan reports it, ordinal in apply order, path) per file.
    The planner measures it: a short list is broadcast to the scan, a long one
    is joined by shuffle."""
    import pyarrow as pa

    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    # from Arrow it is a local relation, whose size the planner knows
    return spark.createDataFrame(pa.table({
        "__qs_uri": pa.array([str(jpath(p).toUri().toString()) for p in paths], pa.string()),
        "__qs_file": pa.array(range(len(paths)), pa.int32()),
        "__qs_path": pa.array(list(paths), pa.string())}))


def _fields(n: int) -> T.StructType:
    return T.StructType([T.StructField(f"_c{i}", T.StringType(), True) for i in range(n)] + [T.StructField(RECORD, T.StringType(), True)])


def _scan(spark: SparkSession, sized: Sequence[tuple[str, int]], names: Sequence[str], delimiter: str,
          encoding: str, kind: str, files: DataFrame) -> DataFrame:
    paths = [p for p, _ in sized]
    options = _options(delimiter, encoding, kind == WHOLE)
    if kind == RECORDS:
        found = assembled(spark, sized, delimiter)
        text = found["record"].cast("string") if options["encoding"] in UTF8 else F.decode("record", options["encoding"])
        schema = ", ".join(f"`{f.name}` string" for f in _fields(len(names)).fields)
        df = found.select("uri", "block", "row", "closed", F.from_csv(text, schema, options).alias("f")).select(
            "f.*", F.col("uri").alias("__qs_uri"), F.col("block").alias("__qs_offset"), F.col("row").alias("__qs_row"), "closed")
    else:
        df = (spark.read.format("csv").options(**options).option("header", "true").option("enforceSchema", "true")
              .schema(_fields(len(names))).load(list(paths)))
        df = df.select("*", F.col("_metadata.file_path").alias("__qs_uri"),
                       F.col("_metadata.file_block_start").alias("__qs_offset"),
                       F.monotonically_increasing_id().alias("__qs_row"), F.lit(True).alias("closed"))
    # file order as a small ordinal (not the path string) so that the position
    # stays a few bytes per row through later shuffles
    # every scanned file is in the list; one that is not must not lose its rows
    df = df.join(files, "__qs_uri", "left").withColumn("__qs_file", F.coalesce(
        "__qs_file", F.raise_error(F.concat(F.lit("scanned file is not in the load: "), "__qs_uri")).cast("int")))
    pos = F.struct(F.col("__qs_file").alias("file"), F.col("__qs_offset").alias("offset"),
                   F.col("__qs_row").alias("row"))
    cols: list[Column] = []
    undefined = F.lit(False)
    for i, n in enumerate(names):
        c = F.col(f"_c{i}")
        if needs_translation(encoding):
            c = decode_column(c, encoding)
            undefined = undefined | F.coalesce(F.instr(c, REPLACEMENT) > 0, F.lit(False))
        cols.append(c.alias(n))
    # a row is bad when it has more fields than the header, or a byte the code
    # page leaves undefined (a strict decoder would refuse the file).  The record
    # is kept only for rows of another length, short or long, so fields are
    # counted there: quoted fields first lose their content
    sep = _quoted(delimiter)
    # (a query may not read the record alone, so nothing of the first field is added)
    raw = F.concat(F.col(RECORD), F.coalesce(F.substring("_c0", 1, 0), F.lit("")))
    plain = F.regexp_replace(raw, f'(^|{sep})"(?:[^"]|"")*"', "$1")
    long = F.regexp_count(plain, F.lit(sep)) + 1 > len(names)
    record = decode_column(F.col(RECORD), encoding) if needs_translation(encoding) else F.col(RECORD)
    bad = (F.when(F.coalesce(long, F.lit(False)), F.concat(F.lit("more fields than the header in "), F.col("__qs_path")))
            .when(undefined, F.concat(F.lit(f"a byte undefined in {encoding} in "), F.col("__qs_path")))
            .when(~F.col("closed"), F.concat(F.lit("a quote left open in "), F.col("__qs_path"))))
    name = F.regexp_extract("__qs_path", r"([^/]*)$", 1)
    return df.select(*cols, bad.alias(EXTRA), record.alias(RECORD), pos.alias(POS), name.alias(SOURCE_FILE))


def _quoted(text: str) -> str:
    """``text`` as a literal of a Java regular expression."""
    return "".join(c if c.isalnum() else "\\" + c for c in text)


def expand_files(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, int]]:
    """(file, length) behind each path: a directory or glob becomes its data
    files (names starting with ``_`` or ``.`` are skipped, as Spark does), in
    name order.  Metadata calls only."""
    from ..session import fs_for

    out: list[tuple[str, int]] = []
    for p in paths:
        fs, jpath = fs_for(spark, p)
        statuses = fs.globStatus(jpath) or []
        for st in statuses:
            if st.isDirectory():
                kids = [k for k in fs.listStatus(st.getPath())
                        if k.isFile() and not k.getPath().getName().startswith(("_", "."))]
                out += sorted((str(k.getPath().toString()), int(k.getLen())) for k in kids)
            else:
                out.append((str(st.getPath().toString()), int(st.getLen())))
    return out


def file_layouts(spark: SparkSession, paths: Sequence[str], delimiter: str = ",") -> DataFrame:
    """One row a file: ``uri``, ``header`` (the bytes of its first line that is
    not empty), whether a quoted name goes on behind that line
    (``header_open``), and ``kind``.  One splittable pass over the lines of all
    files; the line pattern is one for any ASCII-compatible code page."""
    sep = _quoted(delimiter)
    value = F.col("value")
    field = f'(?:"(?:[^"\\r]|"")*+"|[^{sep}"\\r]*+)'
    # (Spark's own line reader drops a line that is blank to Java's trim)
    alone = value.rlike(f"^{field}(?:{sep}{field})*+\\r?$") & ~value.rlike(r"^[\x00-\x20]*$")
    filled = (F.col("block") == 0) & ~value.isin("", "\r", "\ufeff")
    # the kinds of lines as a set: it keeps the aggregate in a hash table, while a
    # string alone would make Spark sort all lines by their file
    sort = F.when(alone, 0).otherwise(1) + F.when(value.rlike(r"\r(?!$)"), 2).otherwise(0)
    found = text_lines(spark, paths).groupBy("uri").agg(
        F.min_by(F.when(filled, value), F.when(filled, F.col("row"))).alias("header"), F.collect_set(sort).alias("sorts"))
    has = lambda bit: F.exists("sorts", lambda x: x.bitwiseAND(bit) != 0)
    kind = F.when(has(2) | F.lit(len(delimiter) != 1), WHOLE).when(has(1), RECORDS).otherwise(LINES)
    opened = F.col("header").rlike(f'^(?:(?:"(?:[^"]|"")*+"[^{sep}]*+|[^"{sep}][^{sep}]*+|){sep})*+"(?:[^"]|"")*+$')
    return found.select("uri", F.col("header").cast("binary").alias("header"), opened.alias("header_open"), kind.alias("kind"))


def header_names(raw: bytes, delimiter: str, encoding: str) -> list[str]:
    """The names in a header's bytes."""
    enc = normalise(encoding)
    text = raw.decode("utf-8-sig" if enc in ("utf-8", "utf8") else enc, errors="replace")
    return pandas_names(next(csv.reader(io.StringIO(text, newline=""), delimiter=delimiter, quotechar='"', doublequote=True), []))


def file_layout_report(spark: SparkSession, paths: str | Sequence[str], required: Sequence[str | Sequence[str]], delimiter: str = ",",
                       encoding: str = "utf-8") -> DataFrame:
    """(path, missing_column) for each landed file and each of ``required`` that
    its header lacks (an entry may be several names, of which one must be
    there; it is reported by its first).  The driver parses each distinct header
    once; files are rows throughout."""
    wanted = [(r,) if isinstance(r, str) else tuple(r) for r in required]
    files = file_layouts(spark, [paths] if isinstance(paths, str) else list(paths), delimiter)
    found = []
    for r in files.select("header").distinct().collect():
        have = set(header_names(bytes(r["header"]), delimiter, encoding)) if r["header"] is not None else set()
        found += [(r["header"], alts[0]) for alts in wanted if not have.intersection(alts)]
    lacking = spark.createDataFrame(found, "header binary, missing_column string")
    return files.join(lacking, files["header"].eqNullSafe(lacking["header"])).select(F.col("uri").alias("path"), "missing_column")


def _layouts(spark: SparkSession, files: Sequence[tuple[str, int]], delimiter: str, encoding: str, multiline,
             header: Sequence[str] | None) -> dict[str, tuple[tuple[str, ...], str]]:
    """(names, kind) of each file.  ``multiline``: "auto" (by what stands in the
    files), or True / False for files known to be read whole / by lines."""
    fixed = None if multiline == "auto" else WHOLE if multiline else LINES
    if normalise(encoding) not in ASCII_COMPATIBLE and not needs_translation(encoding):
        # wide characters: no line pattern applies
        return {p: (tuple(header) if header is not None else tuple(read_header(spark, p, delimiter, encoding)), WHOLE) for p, _ in files}
    if header is not None and fixed:
        return {p: (tuple(header), fixed) for p, _ in files}
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    found = {r["uri"]: r for r in file_layouts(spark, [p for p, _ in files], delimiter).collect()}
    out = {}
    for p, _ in files:
        r = found.get(str(jpath(p).toUri().toString()))
        if header is None and (r is None or r["header"] is None):
            raise ValueError(f"{p}: no header line (empty file)")
        if header is not None:
            names = tuple(header)
        elif r["header_open"] or r["kind"] == WHOLE:
            names = tuple(read_header(spark, p, delimiter, encoding))
        else:
            names = tuple(header_names(bytes(r["header"]), delimiter, encoding))
        out[p] = (names, fixed or (r["kind"] if r is not None else LINES))
    return out


def _check_required(headers: dict[str, tuple[str, ...]], require: Sequence[Sequence[str]]) -> None:
    """Every file must carry, for each entry of ``require``, one of its names
    (a mapped source header or its target name).  Files are checked one by
    one, as a per-file load would, so a layout that lacks a column is not
    hidden by another file that has it."""
    problems = []
    for path, names in headers.items():
        have = set(names)
        missing = [alts[0] for alts in require if not have.intersection(alts)]
        if missing:
            problems.append(f"{path}: {missing}")
    if problems:
        raise ValueError("mapped column(s) missing from landed file(s): " + "; ".join(problems))


def _scan_all(spark: SparkSession, paths: Sequence[str], delimiter: str, encoding: str, multiline,
              header: Sequence[str] | None, require: Sequence[Sequence[str]] = ()) -> DataFrame:
    """One scan per distinct (header, kind), united by column name (a later
    export that adds or reorders columns is read by name, not by position)."""
    files = expand_files(spark, paths)
    if not files:
        raise ValueError("no files to read")
    layouts = _layouts(spark, files, delimiter, encoding, multiline, header)
    if require:
        _check_required({p: names for p, (names, _) in layouts.items()}, require)
    table = _file_table(spark, [p for p, _ in files])
    groups: dict[tuple[tuple[str, ...], str], list[tuple[str, int]]] = {}
    for p, n in files:
        groups.setdefault(layouts[p], []).append((p, n))
    out = None
    for (names, kind), group in groups.items():
        part = _scan(spark, group, list(names), delimiter, encoding, kind, table)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def read_delimited_split(spark: SparkSession, paths: str | Sequence[str], delimiter: str = ",",
                         encoding: str = "utf-8", multiline: bool | str = "auto",
                         header: Sequence[str] | None = None,
                         require: Sequence[Sequence[str]] = (), with_source: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows).  ``with_source`` as in :func:`read_delimited`.  Bad rows keep their fields, ``_pos``, the reason
    in ``bad_reason`` and, if they are too long, the whole record in ``_record``."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = _scan_all(spark, paths, delimiter, encoding, multiline, header, require)
    df = df if with_source else df.drop(SOURCE_FILE)
    good = df.where(F.col(EXTRA).isNull()).drop(EXTRA, RECORD)
    bad = df.where(F.col(EXTRA).isNotNull()).withColumnRenamed(EXTRA, "bad_reason")
    return good, bad


def read_delimited(spark: SparkSession, paths: str | Sequence[str], delimiter: str = ",",
                   encoding: str = "utf-8", multiline: bool | str = "auto", on_bad: str = "error",
                   header: Sequence[str] | None = None, with_position: bool = True,
                   require: Sequence[Sequence[str]] = (), with_source: bool = False) -> DataFrame:
    """Read landed delimited files as strings (see module doc).  Files are
    grouped by their header; each group is one scan.  ``require``: per entry,
    the names one of which every file's header must carry (else ValueError
    naming the files).  ``with_source`` adds the name of each row's file as
    ``_source_file``."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if on_bad not in ("error", "quarantine"):
        raise ValueError("on_bad must be 'error' or 'quarantine'")
    if on_bad == "quarantine":
        df, _ = read_delimited_split(spark, paths, delimiter, encoding, multiline, header, require, with_source)
    else:
        df = _scan_all(spark, paths, delimiter, encoding, multiline, header, require)
        ok = F.when(F.col(EXTRA).isNull(), F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("bad row: "), F.col(EXTRA))))
        df = df.where(ok).drop(EXTRA, RECORD)
        df = df if with_source else df.drop(SOURCE_FILE)
    return df if with_position else df.drop(POS)


def null_tokens(df: DataFrame, tokens: Iterable[str] = PANDAS_NULL_TOKENS,
                subset: Iterable[str] | None = None) -> DataFrame:
    """String cells equal to a token become NULL (one projection)."""
    toks = list(tokens)
    names = set(subset) if subset is not None else None
    out = []
    for f in df.schema.fields:
        c = qcol(f.name)
        if isinstance(f.dataType, T.StringType) and (names is None or f.name in names):
            out.append(F.when(c.isin(toks), F.lit(None).cast("string")).otherwise(c).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def decode_charset(df: DataFrame, encoding: str, subset: Iterable[str] | None = None) -> DataFrame:
    """Re-interpret text read as ISO-8859-1 in a single-byte ``encoding``."""
    names = set(subset) if subset is not None else None
    out = []
    for f in df.schema.fields:
        c = qcol(f.name)
        if isinstance(f.dataType, T.StringType) and (names is None or f.name in names):
            out.append(decode_column(c, encoding).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def write_delimited(df: DataFrame, path: str, delimiter: str = ",", encoding: str = "utf-8") -> None:
    """Land ``df`` as delimited text with a header (one file per partition);
    a code page Spark cannot write is produced by the inverse translation."""
    from ..functions.charsets import encode_column, encode_text

    out = df
    enc = normalise(encoding)
    if needs_translation(encoding):
        out = df.select(*[encode_column(qcol(c).cast("string"), encoding).alias(encode_text(c, encoding))
                          for c in df.columns])
        enc = "iso-8859-1"
    (out.write.mode("errorifexists").option("sep", delimiter).option("header", "true")
        .option("encoding", enc).option("quote", '"').option("escape", '"')
        .option("quoteAll", "false").option("emptyValue", "").csv(path))
