"""Chunks, tokens and CSV text as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

CHUNK_SIZE = 300
OVERLAP = 50


def chunks(text: Column, size: int = CHUNK_SIZE, overlap: int = OVERLAP) -> Column:
    """Substrings of ``size`` characters that start every ``size - overlap``; the last ones may be short.

    The text is cut into pieces of one step, and a chunk is the piece at its start with what it needs of the next ones. So
    the work grows with the length of the text, where a substring from the beginning per chunk would make it grow with its
    square. The pieces stand outside the lambdas, whose bodies run once per chunk.
    """
    step = size - overlap
    if overlap < 0 or step <= 0:
        raise ValueError("overlap must be at least 0 and less than size")
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    out = pieces
    for ahead in range(1, -(-size // step)):
        following = F.slice(pieces, F.lit(ahead + 1), F.greatest(F.length(text), F.lit(0)))
        out = F.zip_with(out, following, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.transform(out, lambda c: F.substring(c, 1, size))


def tokens(text: Column) -> Column:
    """Lower-case words."""
    return F.filter(F.split(F.lower(text), r"(?U)\W+"), lambda t: t != "")


def csv_line(columns: Sequence[str]) -> Column:
    """One row as CSV: fields with a comma, a quote or a line break are quoted, quotes doubled, nulls empty."""
    def field(c: str) -> Column:
        v = F.col(c).cast("string")
        quoted = F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.coalesce(F.when(v.rlike('[,"\r\n]'), quoted).otherwise(v), F.lit(""))

    if len(columns) == 1:  # a lone empty field is written as two quotes
        only = field(columns[0])
        return F.when(only == "", '""').otherwise(only)
    return F.concat_ws(",", *[field(c) for c in columns])


def csv_header(columns: Sequence[str]) -> str:
    return ",".join('"' + c.replace('"', '""') + '"' if any(x in c for x in ',"\r\n') else c for c in columns)
