"""Raw registry dumps: ``;``-delimited, ``"``-quoted, latin1 text, usually without a header.

Reading (:func:`read_dump`) is Spark's CSV source with a fixed all-string schema:

* quoted fields may hold ``;``, newlines and doubled quotes. :func:`multiline_files` finds the files whose
  records span lines with one splittable text scan, so that every other file is parsed line by line. Of
  those, small files are read in ``multiLine`` mode (a task per file) and large ones by
  :mod:`~cadastra.sources.records` (many tasks per file);
* **bad rows**: a row with *more* fields than the schema is dropped; a row with fewer is padded
  with NULLs. Spark's PERMISSIVE mode flags both kinds in ``_corrupt_record``; only the flagged
  rows are re-tokenised to count their fields, so clean rows pay nothing;
* **NULL tokens**: empty fields and the usual NA spellings (``NA``, ``NULL``, ``nan``, …) become
  NULL; matching is exact and case-sensitive;
* **column names** are decided per file from its first *record* (which may span lines): the base's
  dictionary when the width matches, else the file's own header, else ``col_00``, ``col_01``, …

Writing (:func:`write_dump`) produces the same format (every field quoted, no header).
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .records import BLOCK_BYTES, first_record_lines, read_records
from .schema import COLUMNS, NA_TOKENS, null_tokens

# Dump format.
DELIMITER = ";"
QUOTE = '"'
ENCODING = "ISO-8859-1"
CORRUPT = "_corrupt_record"
#: bytes up to which a file whose records may span lines is read whole by one task
WHOLE_BYTES = BLOCK_BYTES
#: rows of one written dump file: readers of multi-line records may take a file whole
FILE_ROWS = 250_000
# First-line header test — a delimiter and at least one letter.
HEADER_LETTERS = r"[A-Za-zÀ-ÿ_]"


def _reader(spark: SparkSession, encoding: str, multiline: bool):
    return (spark.read.option("sep", DELIMITER).option("quote", QUOTE).option("escape", QUOTE)
            .option("encoding", encoding).option("multiLine", str(multiline).lower())
            .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false"))


def _quoted_name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def named(column: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col(_quoted_name(column))


def free_name(name: str, taken, first: int, sign: str) -> str:
    """``name`` with the first number from ``first`` on that makes it none of ``taken`` (upper and lower case alike)."""
    while f"{name}{sign}{first}".lower() in taken:
        first += 1
    return f"{name}{sign}{first}"


def header_names(fields: Sequence[str]) -> list[str]:
    """Names from a header record: blanks become ``Unnamed: n``, repeats get ``.1``, ``.2``, …, counting on
    where the header itself has such a name. Names that differ in case only count as repeats."""
    names = [f if f else f"Unnamed: {i}" for i, f in enumerate(fields)]
    given, used, out = {n.lower() for n in names}, set(), []
    for name in names:
        if name.lower() in used:
            name = free_name(name, given | used, 1, ".")
        used.add(name.lower())
        out.append(name)
    return out


def column_plan(base: str, first_record: Sequence[str], header: bool) -> tuple[list[str], bool]:
    """Column names of one file, and whether its first record is the header they come from."""
    width = len(first_record)
    if len(COLUMNS.get(base, ())) == width:
        return list(COLUMNS[base]), False
    if header:
        return header_names(first_record), True
    return [f"col_{i:02d}" for i in range(width)], False


# States of the field count, by what stands before a place: nothing of the field yet, an open quote, unquoted text, and a
# quote inside quotes (which ends them unless it is doubled).
_BEGIN, _QUOTED, _PLAIN, _CLOSED = range(4)


def count_fields(raw) -> Column:
    """Number of ``;``-separated fields of a raw record: a quote opens a field only at its start, delimiters inside
    quotes do not count. One step per quote character, so any width takes linear time."""
    raw = F.col(raw) if isinstance(raw, str) else raw
    step = lambda state, fields: F.struct(state.alias("state"), fields.alias("fields"))

    def after_text(s: Column, text: Column) -> Column:
        state = (F.when((s["state"] == _QUOTED) | (text == ""), s["state"]).when(text.endswith(DELIMITER), F.lit(_BEGIN))
                 .otherwise(F.lit(_PLAIN)))
        more = F.when(s["state"] == _QUOTED, F.lit(0)).otherwise(F.length(text) - F.length(F.replace(text, F.lit(DELIMITER), F.lit(""))))
        return step(state, s["fields"] + more)

    def after_quote(s: Column) -> Column:
        state = (F.when(s["state"] == _BEGIN, F.lit(_QUOTED)).when(s["state"] == _QUOTED, F.lit(_CLOSED))
                 .when(s["state"] == _CLOSED, F.lit(_QUOTED)).otherwise(F.lit(_PLAIN)))
        return step(state, s["fields"])

    parts = F.split(F.regexp_replace(raw, r"[\r\n]++$", ""), QUOTE)
    begin = after_text(step(F.lit(_BEGIN), F.lit(1)), parts[0])
    return F.aggregate(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), begin,
                       lambda s, text: after_text(after_quote(s), text), lambda s: s["fields"])


def apply_bad_row_policy(df: DataFrame, width: int, observation=None) -> DataFrame:
    """Keep clean and short rows; drop rows that had more fields than ``width``.
    With an ``Observation``, the numbers of dropped long rows and padded short rows are
    recorded in the same pass (``long_rows``, ``short_rows``)."""
    too_long = F.col(CORRUPT).isNotNull() & (count_fields(F.col(CORRUPT)) > F.lit(width))
    if observation is not None:
        df = df.observe(observation,
                        F.sum(F.when(too_long, 1).otherwise(0)).alias("long_rows"),
                        F.sum(F.when(F.col(CORRUPT).isNotNull() & ~too_long, 1).otherwise(0)).alias("short_rows"))
    return df.where(~too_long | F.col(CORRUPT).isNull()).drop(CORRUPT)


def apply_null_tokens(df: DataFrame, columns: Sequence[str] | None = None,
                      tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    wanted = set(columns or df.columns)
    return df.select(*[null_tokens(named(c), tokens).alias(c) if c in wanted else named(c) for c in df.columns])


def by_size(spark: SparkSession, paths: str | Sequence[str], encoding: str = ENCODING) -> tuple[str | list[str], list[str], list[str]]:
    """``paths`` as what one task may read whole, the larger files whose records are single lines, and the larger ones
    with records that span lines. Without large files the paths stay as they are."""
    files = (spark.read.format("binaryFile").load([paths] if isinstance(paths, str) else list(paths))
             .select(F.col("_metadata.file_path").alias("uri"), (F.col("length") > WHOLE_BYTES).alias("large")))
    large = [r["uri"] for r in files.where("large").collect()]
    if not large:
        return paths, [], []
    # no line that begins outside quotes ends inside them: then none begins inside
    rest = F.regexp_replace("value", r'(^|;)"[^"]*+(?:""[^"]*+)*+"', "$1")
    lines = spark.read.option("encoding", encoding).text(large).select(F.col("_metadata.file_path").alias("uri"), rest.rlike('(^|;)"').alias("open"))
    spans = {r["uri"] for r in lines.where("open").select("uri").distinct().collect()}
    return [r["uri"] for r in files.where("NOT large").collect()], [u for u in large if u not in spans], sorted(spans)


def parsed(records: DataFrame, schema: StructType, header: bool, encoding: str) -> DataFrame:
    """Records of :func:`~cadastra.sources.records.read_records` as rows of ``schema``; ``header``: without the first
    record of every file."""
    if header:
        records = records.where("NOT (block = 0 AND n = 0)")
    options = {"sep": DELIMITER, "quote": QUOTE, "escape": QUOTE, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    text = F.regexp_replace(F.decode("data", encoding), r"\r\z", "")
    ddl = ", ".join(f"{_quoted_name(f.name)} string" for f in schema.fields)
    row = records.select(F.from_csv(text, ddl, options).alias("_row"))
    return row.select(*[F.col("_row").getField(f.name).alias(f.name) for f in schema.fields])


def _split_rows(spark: SparkSession, paths, schema: StructType, header: bool, encoding: str, block_bytes: int) -> DataFrame:
    return parsed(read_records(spark, paths, block_bytes), schema, header, encoding)


def read_dump(spark: SparkSession, paths: str | Sequence[str], names: Sequence[str],
              header: bool = False, encoding: str = ENCODING, multiline: bool | str = True,
              observation=None, block_bytes: int = BLOCK_BYTES, keep_uri: str | None = None) -> DataFrame:
    """Read dump files into the given all-string columns with the bad-row and NULL-token rules.
    ``keep_uri`` names a further column for the file that a row comes from (not in split mode).

    ``multiline``: True for records that may span lines, a task per file of at most ``WHOLE_BYTES`` and many per larger
    one (with ``keep_uri`` one per file); ``"split"`` for the same with a task per ``block_bytes`` of a file; False for
    records of one line.
    """
    schema = StructType([StructField(n, StringType(), True) for n in names]
                        + [StructField(CORRUPT, StringType(), True)])
    if multiline == "split":
        df = _split_rows(spark, paths, schema, header, encoding, block_bytes)
    else:
        small, lines, spans = by_size(spark, paths, encoding) if multiline and not keep_uri else (paths, [], [])
        read = lambda files, whole: (_reader(spark, encoding, whole).option("header", str(header).lower())
                                     .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
                                     .schema(schema).csv(files if isinstance(files, str) else list(files)))
        parts = [read(files, whole) for files, whole in ((small, multiline), (lines, False)) if files]
        parts += [_split_rows(spark, spans, schema, header, encoding, block_bytes)] if spans else []
        df = reduce(DataFrame.unionByName, parts)
        if keep_uri:
            df = df.withColumn(keep_uri, F.col("_metadata.file_path"))
    df = apply_bad_row_policy(df, len(names), observation)
    return apply_null_tokens(df, names)


def read_base_dump(spark: SparkSession, paths, base: str, **kw) -> DataFrame:
    return read_dump(spark, paths, COLUMNS[base], **kw)


def write_dump(df: DataFrame, path: str, encoding: str = ENCODING, header: bool = False) -> None:
    (df.write.mode("overwrite").option("sep", DELIMITER).option("quote", QUOTE).option("escape", QUOTE)
     .option("quoteAll", "true").option("encoding", encoding).option("header", str(header).lower())
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .option("maxRecordsPerFile", FILE_ROWS).csv(path))


def write_lines(lines: DataFrame, path: str) -> None:
    """Write rendered lines as a dump."""
    lines.write.option("maxRecordsPerFile", FILE_ROWS).text(path)


def render_lines(df: DataFrame, columns: Sequence[str] | None = None) -> F.Column:
    """One dump line per row: every field quoted (quotes doubled), NULL as an empty quoted field."""
    cols = list(columns or df.columns)
    quoted = [F.concat(F.lit(QUOTE), F.regexp_replace(F.coalesce(F.col(c), F.lit("")), QUOTE, QUOTE * 2),
                       F.lit(QUOTE)) for c in cols]
    return F.concat_ws(DELIMITER, *quoted)


# ---------------------------------------------------------------------------------------------
# file-level metadata: first record, header test, base from the file name
# ---------------------------------------------------------------------------------------------
BLOCK = 1 << 16


def first_record(stream, encoding: str = ENCODING) -> str:
    """Text of the first record of an open file that is not blank: read on until it is complete, however long it is."""
    lines = first_record_lines(iter(io.BufferedReader(stream, BLOCK).readline, b""))
    return b"".join(lines).decode(encoding, errors="ignore").rstrip("\r\n")


def split_record(record: str) -> list[str]:
    csv.field_size_limit(max(csv.field_size_limit(), len(record)))
    return next(csv.reader(io.StringIO(record, newline=""), delimiter=DELIMITER, quotechar=QUOTE), [])


def _first_records(batches: Iterator[pd.DataFrame], encoding: str) -> Iterator[pd.DataFrame]:
    from pyarrow import fs as pafs
    for pdf in batches:
        records, fields, failures = [], [], []
        for p in pdf["path"]:
            record, failure = None, None
            try:
                filesystem, inner = pafs.FileSystem.from_uri(p)
                with filesystem.open_input_stream(inner, compression=None) as f:
                    record = first_record(f, encoding)
            except OSError as e:  # this file is reported; the others go on
                failure = f"{type(e).__name__}: {e}"[:500]
            records.append(record)
            fields.append(split_record(record) if record else [])
            failures.append(failure)
        yield pd.DataFrame({"path": pdf["path"], "first_record": records, "fields": fields, "failure": failures})


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Files under ``root`` (path, name, length); file contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(root)
            .select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "length"))


def file_profiles(files: DataFrame, encoding: str = ENCODING) -> DataFrame:
    """``files`` with first record, its fields, the header test, and the failure of unreadable ones.
    Each file is opened by one task, which reads up to the end of its first record."""
    first = files.select("path").mapInPandas(
        lambda it: _first_records(it, encoding), "path string, first_record string, fields array<string>, failure string")
    line = F.split_part("first_record", F.lit("\n"), F.lit(1))
    return files.join(first, "path").withColumn("has_header", has_header(line))


def multiline_files(spark: SparkSession, paths: Sequence[str], encoding: str = ENCODING) -> DataFrame:
    """Per file: does any record continue on the next line (a line with an odd number of quote
    characters)? A splittable text scan answers it in parallel; only the files that do need the
    unsplittable multi-line CSV mode."""
    lines = spark.read.option("encoding", encoding).text(list(paths))
    odd = F.pmod(F.length("value") - F.length(F.regexp_replace("value", QUOTE, "")), F.lit(2)) == 1
    return (lines.select(F.col("_metadata.file_path").alias("path"), odd.alias("odd"))
            .groupBy("path").agg(F.max("odd").alias("multiline")))


def has_header(line: Column) -> Column:
    """A delimiter and at least one letter in the first line."""
    return F.coalesce(line.contains(DELIMITER) & line.rlike(HEADER_LETTERS), F.lit(False))
