"""Header-less comma text -> typed rows, with bad lines set aside.

Lines are split on ',' (positional schema, extra trailing fields ignored);
ids must be integers (BIGINT).  Ratings must be finite numbers; a user's
gender and age and a book's average become null when they are not, and the
row is kept.  Every line lands in exactly one of two frames: ``good`` (typed) or
``rejected`` (``line``, ``reason``).  One malformed line never fails a job.

The CSV reader is not used on purpose: it would mark a line with an extra
field as corrupt, where the feed contract keeps it.  ``try_cast`` trims
surrounding blanks (``' 2'`` -> 2), which we accept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.sources.keyed import SEQ

_INT_PATTERN = r"^\s*[+-]?[0-9]+\s*$"

# Fixed reject reasons.
EMPTY_LINE = "empty line"
TOO_FEW_FIELDS = "too few fields"
BAD_ID = "id not an integer"
ID_OUT_OF_RANGE = "id out of range"
BAD_NUMBER = "not a number"
NOT_FINITE = "number not finite"


@dataclass
class Parsed:
    """Both sides of a parse.  ``tagged`` is the single underlying frame."""

    tagged: DataFrame
    good: DataFrame
    rejected: DataFrame


def _field(fields: Column, i: int) -> Column:
    return F.try_element_at(fields, F.lit(i + 1))


def _int_check(raw: Column) -> tuple[Column, Column]:
    """(value, reason) for an id field."""
    wide = F.trim(raw).try_cast("bigint")
    reason = F.when(~raw.rlike(_INT_PATTERN), F.lit(BAD_ID)).when(wide.isNull(), F.lit(ID_OUT_OF_RANGE))
    return F.when(raw.rlike(_INT_PATTERN), wide), reason


def _double_check(raw: Column) -> tuple[Column, Column]:
    """(value, reason) for a number that must be there."""
    value = F.trim(raw).try_cast("double")
    reason = F.when(value.isNull(), F.lit(BAD_NUMBER)).when(~_finite(value), F.lit(NOT_FINITE))
    return value, reason


def _finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))


def _double_or_null(raw: Column) -> Column:
    """The number, or null where the field is empty or holds anything else."""
    value = F.trim(raw).try_cast("double")
    return F.when(_finite(value), value)


def _first_reason(reasons: list[Column]) -> Column:
    return F.coalesce(*reasons)


def _tag(lines: DataFrame, line_col: str, n_fields: int, typed: dict, keep: list[str]) -> DataFrame:
    """Generic tagging: ``typed`` maps output column -> (index, kind)."""
    raw = F.col(line_col)
    fields = F.split(raw, ",", -1)
    cols = {}
    reasons = [
        F.when(raw.isNull() | (F.trim(raw) == ""), F.lit(EMPTY_LINE)),
        F.when(F.size(fields) < n_fields, F.lit(TOO_FEW_FIELDS)),
    ]
    for name, (idx, kind) in typed.items():
        piece = _field(fields, idx)
        if kind == "id":
            value, reason = _int_check(piece)
        elif kind == "double":
            value, reason = _double_check(piece)
        elif kind == "double_or_null":
            value, reason = _double_or_null(piece), None
        else:  # text, kept as written
            value, reason = piece, None
        cols[name] = value
        if reason is not None:
            reasons.append(F.when(piece.isNotNull(), reason))
    out = lines.select(
        *keep,
        raw.alias("line"),
        *[v.alias(k) for k, v in cols.items()],
        _first_reason(reasons).alias("reason"),
    )
    return out


def _split(tagged: DataFrame, out_cols: list[str], keep: list[str]) -> Parsed:
    good = tagged.filter(F.col("reason").isNull()).select(*keep, *out_cols)
    rejected = tagged.filter(F.col("reason").isNotNull()).select(*keep, "line", "reason")
    return Parsed(tagged, good, rejected)


def parse_ratings(lines: DataFrame, line_col: str = "value", keep: list[str] | None = None) -> Parsed:
    """``user,product,rating`` -> (user_id BIGINT, product_id BIGINT, rating DOUBLE)."""
    keep = keep or []
    spec = {"user_id": (0, "id"), "product_id": (1, "id"), "rating": (2, "double")}
    tagged = _tag(lines, line_col, 3, spec, keep)
    return _split(tagged, list(spec), keep)


def parse_users(lines: DataFrame, line_col: str = "value", keep: list[str] | None = None) -> Parsed:
    """``userId,nickName,gender,age,readStyle,userLabel``; a gender or age that is no number is null."""
    keep = keep or []
    spec = {
        "user_id": (0, "id"),
        "nick_name": (1, "text"),
        "gender": (2, "double_or_null"),
        "age": (3, "double_or_null"),
        "read_style": (4, "text"),
        "user_label": (5, "text"),
    }
    tagged = _tag(lines, line_col, 6, spec, keep)
    return _split(tagged, list(spec), keep)


def parse_books(lines: DataFrame, line_col: str = "value", keep: list[str] | None = None) -> Parsed:
    """``bookId,bookName,author,average,bookStyle,bookLabel``; an average that is no number is null.

    The label is field 6; the original book feed stored field 4 (the average)
    as the label, which we treat as a defect.
    """
    keep = keep or []
    spec = {
        "book_id": (0, "id"),
        "book_name": (1, "text"),
        "author": (2, "text"),
        "average": (3, "double_or_null"),
        "book_style": (4, "text"),
        "book_label": (5, "text"),
    }
    tagged = _tag(lines, line_col, 6, spec, keep)
    return _split(tagged, list(spec), keep)


def sequenced(lines: DataFrame) -> DataFrame:
    """Adds ``_seq``: where each line stands, so that the last line of a key can win.

    Lines follow by their file's modification time, then file, then block
    and place in it.  Frames that carry ``_seq_file`` (see ``with_file``)
    keep it; others count as one file in the order of their partitions.
    """
    if SEQ in lines.columns:
        return lines
    pos = F.monotonically_increasing_id().alias("pos")
    if SEQ_FILE in lines.columns:
        parts = [F.col(f"{SEQ_FILE}.{c}").alias(c) for c in ("at", "file", "block")]
        return lines.withColumn(SEQ, F.struct(*parts, pos)).drop(SEQ_FILE)
    return lines.withColumn(SEQ, F.struct(*[F.lit(0).cast("bigint").alias(c) for c in ("at", "file", "block")], pos))


#: Column with modification time, file and block of a line.
SEQ_FILE = "_seq_file"


def with_file(lines: DataFrame) -> DataFrame:
    """Lines of a file source (batch or stream) with the file they come from."""
    meta = F.struct(
        F.unix_millis("_metadata.file_modification_time").alias("at"),
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").cast("bigint").alias("block"),
    )
    return lines.select("value", meta.alias(SEQ_FILE))


def _read_lines(spark: SparkSession, path: str) -> DataFrame:
    return sequenced(with_file(spark.read.text(path)))


def read_ratings(spark: SparkSession, path: str, keep: list[str] | None = None) -> Parsed:
    return parse_ratings(_read_lines(spark, path), keep=keep)


def read_users(spark: SparkSession, path: str, keep: list[str] | None = None) -> Parsed:
    return parse_users(_read_lines(spark, path), keep=keep)


def read_books(spark: SparkSession, path: str, keep: list[str] | None = None) -> Parsed:
    return parse_books(_read_lines(spark, path), keep=keep)


def write_lines(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a ``value`` column as plain text (one line per row)."""
    lines.select("value").write.mode(mode).text(path)


def tokens_to_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Whitespace tokenising of appended lines: one token becomes one line.

    The original history append split each incoming line on whitespace and
    wrote every token on its own line; ``1,2,3 4,5,1`` is two ratings.
    """
    tokens = F.posexplode(F.split(F.trim(F.col(line_col)), r"\s+"))
    if SEQ not in lines.columns:
        return lines.select(tokens.alias("_nth", line_col)).filter(F.col(line_col) != "").drop("_nth")
    # a line's tokens follow each other: lines are far apart in pos * 2^20
    placed = lines.select(SEQ, tokens.alias("_nth", line_col)).filter(F.col(line_col) != "")
    seq = F.struct(*[F.col(f"{SEQ}.{c}").alias(c) for c in ("at", "file", "block")], (F.col(f"{SEQ}.pos") * 1048576 + F.col("_nth")).alias("pos"))
    return placed.select(F.col(line_col), seq.alias(SEQ))
