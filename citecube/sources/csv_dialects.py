"""The two CSV dialects of the record files, as Spark sources and sinks.

*Escaped* (the star job's input/output and the Hive external tables):
``,`` delimiter, ``\\`` escape, no quoting, one record per ``\\n``, the empty
field reads as NULL.  Spark's CSV reader cannot parse it (with quoting off
it still splits at an escaped ``\\,``), so the scan is ``read.text`` plus a
tokenizer written with built-in regex/array functions; the sink escapes
with ``regexp_replace`` and writes ``concat_ws`` lines.  Both stay in the
JVM and are splittable (a record never spans a line: CR/LF are escaped).

*Quoted*: ``"`` quote, doubled quotes inside, quoting only where needed,
empty field = NULL.  Files with a header are read by Spark's CSV source; record
files by ``csv_scan``, which splits large files and keeps every record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shuffle_partitions
from . import csv_scan

# Escape sequences of the escaped dialect (escape char "\").
# Written: backslash, delimiter, CR, LF.  Read: \r \n \t \b \f map to
# control characters, an escaped meta character (delimiter or escape) to
# itself, any other escaped character stays as written (backslash kept).
ESCAPE = "\\"
DELIMITER = ","
READ_ESCAPES = {"r": "\r", "n": "\n", "t": "\t", "b": "\b", "f": "\f"}
META = (DELIMITER, ESCAPE)


def _escape_field(c: Column) -> Column:
    s = c.cast("string")
    # literal replacements (no regex), escape character first
    for raw, escaped in ((ESCAPE, ESCAPE + ESCAPE), (DELIMITER, ESCAPE + DELIMITER),
                         ("\r", ESCAPE + "r"), ("\n", ESCAPE + "n")):
        s = F.replace(s, F.lit(raw), F.lit(escaped))
    return F.coalesce(s, F.lit(""))


def to_escaped_lines(df: DataFrame) -> DataFrame:
    """One ``value`` line per row in the escaped dialect (NULL -> empty)."""
    return df.select(F.concat_ws(DELIMITER, *[_escape_field(F.col(c)) for c in df.columns]).alias("value"))


def write_escaped(df: DataFrame, path: str, order_by: str | None = None) -> None:
    """Escaped CSV sink.  With ``order_by`` the files are range-partitioned
    and sorted on that column (part files in key order, many writers)."""
    if order_by:
        n = shuffle_partitions(df.sparkSession)
        df = df.repartitionByRange(n, order_by).sortWithinPartitions(order_by)
    to_escaped_lines(df).write.mode("overwrite").option("lineSep", "\n").text(path)


def _unescape(field: Column) -> Column:
    """Undo escapes in one pass: tokens are either an escape pair or a run
    of plain characters; pairs are mapped, runs kept."""
    tokens = F.regexp_extract_all(field, F.lit(r"\\[\s\S]|[^\\]++"), F.lit(0))

    def tok(t):
        second = F.substring(t, 2, 1)
        mapped = F.lit(None).cast("string")
        expr = None
        for k, v in READ_ESCAPES.items():
            expr = (F.when(second == k, F.lit(v)) if expr is None else expr.when(second == k, F.lit(v)))
        expr = expr.when(second.isin(*META), second).otherwise(t)
        return F.when(F.startswith(t, F.lit(ESCAPE)) & (F.length(t) == 2), expr).otherwise(t)

    return F.array_join(F.transform(tokens, tok), "")


def split_escaped(line: Column) -> Column:
    """Escaped line -> array of raw (still escaped) fields.  The leading comma
    makes an empty first field visible to the tokenizer."""
    # Unrolled loop with possessive quantifiers: plain runs are matched
    # iteratively, so the regex engine recurses per escape, not per char.
    return F.regexp_extract_all(F.concat(F.lit(DELIMITER), line),
                                F.lit(r",([^,\\]*+(?:\\[\s\S][^,\\]*+)*+)"), F.lit(1))


def parse_escaped(line: Column) -> Column:
    """Escaped line -> array of fields (empty field -> NULL)."""
    return F.transform(split_escaped(line),
                       lambda f: F.when(f == "", F.lit(None).cast("string"))
                       .when(F.contains(f, F.lit(ESCAPE)), _unescape(f)).otherwise(f))


def read_escaped_fields(spark: SparkSession, path: str, skip_empty: bool = False, limit: int = 0) -> DataFrame:
    """Escaped CSV scan -> ``fields ARRAY<STRING>``.  An empty line is a record
    with one empty field; ``skip_empty`` leaves such lines out.  ``limit`` > 0
    keeps the first N lines in input order, before any of them is parsed."""
    if limit > 0:
        lines = csv_scan.first_lines(spark, path, limit, skip_empty)
    else:
        lines = spark.read.option("lineSep", "\n").text(path).select(F.regexp_replace("value", "\r$", "").alias("value"))
        if skip_empty:
            lines = lines.filter(F.col("value") != "")
    return lines.select(parse_escaped(F.col("value")).alias("fields"))


def typed_projection(fields: Column, indices: list[int], schema: T.StructType,
                     strict: bool = False) -> list[Column]:
    """Pick fields by position and convert them.  A NULL field is read as the
    empty string first, as the record mapper does.  ``strict`` fails the job on
    a record without the field and on a value that does not convert, the empty
    one included; otherwise both become NULL (a missing text: empty)."""
    cols = []
    for i, f in zip(indices, schema.fields):
        raw = F.coalesce(F.try_element_at(fields, F.lit(i + 1)), F.lit(""))
        v = raw if isinstance(f.dataType, T.StringType) else raw.try_cast(f.dataType)
        if strict:
            # fails the job whatever spark.sql.ansi.enabled says
            v = (F.when(F.size(fields) <= i, F.raise_error(F.lit(f"record has no field {i}")))
                 .when(v.isNull(), F.raise_error(F.concat(
                     F.lit(f"cannot convert field {i} to {f.dataType.simpleString()}: "), raw)))
                 .otherwise(v))
        cols.append(v.alias(f.name))
    return cols


def read_escaped(spark: SparkSession, path: str, schema: T.StructType,
                 indices: list[int] | None = None, strict: bool = False,
                 limit: int = 0, skip_empty: bool = False) -> DataFrame:
    """Typed escaped-CSV scan.  ``indices`` selects source positions
    (default: 0..n-1), ``limit`` > 0 keeps the first N records in input order."""
    rows = read_escaped_fields(spark, path, skip_empty, limit)
    idx = indices if indices is not None else list(range(len(schema.fields)))
    return rows.select(*typed_projection(F.col("fields"), idx, schema, strict))


def write_quoted(df: DataFrame, path: str, header: bool = False, sep: str = ",",
                 order_by: str | None = None) -> None:
    if order_by:
        n = shuffle_partitions(df.sparkSession)
        df = df.repartitionByRange(n, order_by).sortWithinPartitions(order_by)
    if len(df.columns) == 1 and not header:      # Spark would write a lone NULL as an empty line, which readers skip
        df.select(_record([F.col(df.columns[0]).cast("string")]).alias("value")).write.mode("overwrite").option(
            "lineSep", "\n").text(path)
        return
    (df.write.mode("overwrite").option("sep", sep).option("quote", '"').option("escape", '"')
     .option("header", header).option("nullValue", "").option("lineSep", "\n")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def read_quoted(spark: SparkSession, path: str, schema: T.StructType, header: bool = False,
                sep: str = ",") -> DataFrame:
    """Quoted CSV scan; fails on a record that is not one of ``schema``."""
    if not header and sep == DELIMITER:
        return _strict(csv_scan.scan_quoted(spark, path), schema)
    return (spark.read.schema(schema).option("sep", sep).option("quote", '"').option("escape", '"')
            .option("header", header).option("multiLine", True).option("nullValue", "")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("mode", "FAILFAST").csv(path))


def _strict(rows: DataFrame, schema: T.StructType) -> DataFrame:
    values = [F.get("fields", F.lit(i)).try_cast(f.dataType) for i, f in enumerate(schema.fields)]
    fits = F.col("reason").isNull() & (F.size("fields") == len(values))
    for i, v in enumerate(values):
        fits = fits & (F.get("fields", F.lit(i)).isNull() | v.isNotNull())
    failed = F.raise_error(F.concat(F.lit("not a record of the schema: "), F.coalesce("reason", F.lit("")), F.lit(" "), "raw"))
    rows = rows.where(F.when(fits, True).otherwise(failed.cast("boolean")))
    return rows.select(*[v.alias(f.name) for v, f in zip(values, schema.fields)])


def convert(spark: SparkSession, src: str, dst: str, schema: T.StructType,
            direction: str, limit: int = 0) -> None:
    """``csv IN OUT --quoted-to-escaped | --escaped-to-quoted [--limit N]``:
    limit 0 converts everything, otherwise the first N records in file order."""
    if direction == "escaped-to-quoted":
        df = read_escaped(spark, src, schema, limit=limit)
        write_quoted(df, dst)
    elif direction == "quoted-to-escaped":
        rows = csv_scan.first_records(spark, src, limit) if limit > 0 else csv_scan.scan_quoted(spark, src)
        write_escaped(_strict(rows, schema), dst)
    else:
        raise ValueError(f"unknown direction {direction!r}")


def write_pipe_header(df: DataFrame, path: str, order_by: str | None = None) -> None:
    """Pipe-delimited CSV with a header line."""
    write_quoted(df, path, header=True, sep="|", order_by=order_by)


def read_pipe_header(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_quoted(spark, path, schema, header=True, sep="|")


def _quote_minimal(f: Column) -> Column:
    """One field in the quoted dialect: quoted (inner quotes doubled) when it
    holds a delimiter, quote, CR/LF, or surrounding blanks; NULL -> empty."""
    needs = f.rlike(r'[",\r\n]') | f.rlike(r"^\s|\s$")
    quoted = F.concat(F.lit('"'), F.replace(f, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.coalesce(F.when(needs, quoted).otherwise(f), F.lit(""))


def _record(fields: list[Column]) -> Column:
    """One record of the quoted dialect; a lone empty field is written ``""``."""
    line = F.array_join(F.transform(F.array(*fields), _quote_minimal), DELIMITER)
    return F.when(line == "", F.lit('""')).otherwise(line) if len(fields) == 1 else line


def read_quoted_fields(spark: SparkSession, path: str, limit: int = 0) -> DataFrame:
    """Quoted CSV scan -> ``fields ARRAY<STRING>``, any number per record.  An
    empty field is NULL; a record that breaks the dialect fails the job."""
    rows = csv_scan.first_records(spark, path, limit) if limit > 0 else csv_scan.scan_quoted(spark, path)
    failed = F.raise_error(F.concat("reason", F.lit(": "), "raw")).cast("boolean")
    return rows.where(F.when(F.col("reason").isNull(), True).otherwise(failed)).select("fields")


def convert_records(spark: SparkSession, src: str, dst: str, direction: str, limit: int = 0) -> None:
    """Schema-less, record-exact dialect conversion (any number of fields per
    record, none lost and none added)."""
    if direction == "escaped-to-quoted":
        fields = read_escaped_fields(spark, src, limit=limit)
        line = F.array_join(F.transform("fields", _quote_minimal), DELIMITER)
        line = F.when(line == "", F.lit('""')).otherwise(line)
    elif direction == "quoted-to-escaped":
        fields = read_quoted_fields(spark, src, limit)
        line = F.array_join(F.transform("fields", _escape_field), DELIMITER)
    else:
        raise ValueError(f"unknown direction {direction!r}")
    fields.select(line.alias("value")).write.mode("overwrite").option("lineSep", "\n").text(dst)
