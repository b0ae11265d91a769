"""Scalar cleaning rules of the import and the star-schema job, written as
built-in column expressions (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import CITE_PLACEHOLDER


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_list(c) -> Column:
    """``|``-joined list -> array, with the semantics of a Java regex split:
    trailing empty items are dropped, ``""`` gives one empty item and an
    input made only of separators gives no item."""
    c = _c(c)
    stripped = F.regexp_replace(c, r"\|+$", "")
    return (F.when(c.rlike(r"^\|+$"), F.array().cast("array<string>"))
            .otherwise(F.split(stripped, r"\|")))


def join_list(arr) -> Column:
    """array -> ``|``-joined string.  A ``|`` inside an item becomes ``-``;
    no separator is written while the output is still empty, so leading
    empty items vanish."""
    arr = _c(arr)
    joined = F.array_join(F.transform(arr, lambda x: F.replace(x, F.lit("|"), F.lit("-"))), "|")
    return F.regexp_replace(joined, r"^\|+", "")


def clean_key(c) -> Column:
    """Drop the first four characters when the value contains ``ref:``
    anywhere (not only as a prefix)."""
    c = _c(c)
    return F.when(c.contains("ref:"), c.substr(F.lit(5), F.length(c))).otherwise(c)


def decade(year) -> Column:
    """Two-digit decade of a year: 1994 -> 90, 2005 -> 0, 2015 -> 10."""
    y = _c(year).cast("long")
    return ((y % 100) - (y % 10)).cast("long")


def safe_int(c) -> Column:
    """Java-style integer parse: optional sign and ASCII digits only, no
    blanks; anything else (or an overflow) gives NULL."""
    c = _c(c)
    return F.when(c.rlike(r"^[+-]?[0-9]+$"), c.try_cast("int"))


def last_parseable_int(arr) -> Column:
    """Last value of a repeated field that parses as an integer, else 0: a
    bad value never overwrites an earlier good one."""
    parsed = F.filter(F.transform(_c(arr), lambda x: safe_int(x)), lambda x: x.isNotNull())
    return F.coalesce(F.try_element_at(parsed, F.lit(-1)), F.lit(0))


def drop_placeholder(arr) -> Column:
    """Remove the ``...`` placeholder from a list of citations."""
    return F.filter(_c(arr), lambda x: x != F.lit(CITE_PLACEHOLDER))


def venue_string(crossref, journal, volume, issue) -> Column:
    """``ref:`` + crossref; else journal#volume#issue when either number is
    positive; else the journal; else ``""``."""
    crossref, journal, volume, issue = map(_c, (crossref, journal, volume, issue))
    return (F.when(crossref.isNotNull(), F.concat(F.lit("ref:"), crossref))
            .when(journal.isNotNull() & ((volume > 0) | (issue > 0)),
                  F.concat_ws("#", journal, volume.cast("string"), issue.cast("string")))
            .when(journal.isNotNull(), journal)
            .otherwise(F.lit("")))


def acm_venue_string(journal, volume, issue) -> Column:
    """ACM variant: no crossref; a ``#`` in the series name becomes ``:``
    only in the volume/issue form."""
    journal, volume, issue = map(_c, (journal, volume, issue))
    return (F.when(journal.isNotNull() & ((volume > 0) | (issue > 0)),
                   F.concat_ws("#", F.replace(journal, F.lit("#"), F.lit(":")),
                               volume.cast("string"), issue.cast("string")))
            .when(journal.isNotNull(), journal)
            .otherwise(F.lit("")))


# Fixed value: whole-string, case-insensitive "volume N , issue M ..." form
# of an ACM venue text ('.' does not cross a line break).
VOLUME_ISSUE_PATTERN = r"(?i)^volume\s+([0-9]+)\s+,\s+issue\s+([0-9]+)\s+.*\z"


def volume_issue(c) -> tuple[Column, Column]:
    """(volume, issue) read from a venue text, 0 when the text does not
    match; an unparsable volume leaves both at 0."""
    c = _c(c)
    matches = c.rlike(VOLUME_ISSUE_PATTERN)
    vol = F.regexp_extract(c, VOLUME_ISSUE_PATTERN, 1).try_cast("int")
    iss = F.regexp_extract(c, VOLUME_ISSUE_PATTERN, 2).try_cast("int")
    ok = matches & vol.isNotNull()
    volume = F.when(ok, vol).otherwise(F.lit(0))
    issue = F.when(ok & iss.isNotNull(), iss).otherwise(F.lit(0))
    return volume, issue


def trim_ctl(c) -> Column:
    """Java ``String.trim``: strip every character <= U+0020 at both ends
    (Spark's ``trim`` strips blanks only)."""
    return F.regexp_replace(_c(c), r"^[\x00-\x20]+|[\x00-\x20]+\z", "")
