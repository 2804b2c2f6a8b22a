"""Column functions over file content: decoding, hashes, lines, clipping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from treelens import constants as K
from treelens.functions.regex import one_of

BOM = "\ufeff"
_CONTROL = "".join(chr(c) for c in range(1, 32) if c not in (9, 10, 13))


def is_binary(df: DataFrame, name: str = "content") -> bool:
    return df.schema[name].dataType.typeName() == "binary"


def byte_length(content) -> Column:
    return F.octet_length(content).cast("bigint")


def content_sha256(content) -> Column:
    """SHA-256 over all bytes of the content, as hex."""
    return F.sha2(content, 256)


def refusal(content, binary: bool) -> Column:
    """Why content is no readable text: null content, NUL, control bytes, bad UTF-8.

    One scan for any suspicious character settles nearly all files.
    """
    content = F.col(content) if isinstance(content, str) else content
    text = content.cast("string")
    # Control characters are single bytes, so their count is a number of bytes.
    control = F.regexp_count(text, F.lit(one_of(_CONTROL)))
    heavy = (control > K.CONTROL_MIN_COUNT) & (
        control / F.greatest(F.lit(1), F.octet_length(text)) > K.CONTROL_MAX_SHARE
    )
    suspicious = text.rlike(one_of("\x00" + _CONTROL))
    out = (
        F.when(content.isNull(), "not-readable")
        .when(suspicious & F.contains(text, F.lit("\x00")), "binary")
        .when(suspicious & heavy, "control-heavy")
    )
    return out.when(~F.is_valid_utf8(text), "malformed-utf8") if binary else out


def encoding(content) -> Column:
    """'utf-8-bom' when the bytes start with a byte order mark, else 'utf-8'."""
    content = F.col(content) if isinstance(content, str) else content
    bom = F.startswith(content.cast("string"), F.lit(BOM))
    return F.when(bom, "utf-8-bom").otherwise("utf-8")


def decoded(content) -> Column:
    """Text without its byte order mark."""
    text = (F.col(content) if isinstance(content, str) else content).cast("string")
    bom = F.startswith(text, F.lit(BOM))
    return F.when(bom, F.substr(text, F.lit(2))).otherwise(text)


def split_lines(text) -> Column:
    """CRLF or LF ends a line; a lone CR is data; a trailing break adds an empty line."""
    return F.split(F.replace(text, F.lit("\r\n"), F.lit("\n")), "\n", -1)


def line_count(text) -> Column:
    """Number of lines without building them: line feeds plus one."""
    text = F.col(text) if isinstance(text, str) else text
    feeds = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    return (feeds + 1).cast("bigint")


def is_long(line: Column) -> Column:
    return F.length(line) > K.CLIP_CHARS


def clip(line: Column) -> Column:
    """First 320 characters and '...' when the line is longer."""
    head = F.concat(F.substr(line, F.lit(1), F.lit(K.CLIP_CHARS)), F.lit("..."))
    return F.when(is_long(line), head).otherwise(line)


def excerpt(line: Column, query: str, case_sensitive: bool = False) -> Column:
    """A 320-character window around the first hit, '...' on each cut side."""
    hay = line if case_sensitive else F.lower(line)
    needle = F.lit(query) if case_sensitive else F.lower(F.lit(query))
    size = F.length(line)
    lead = max(0, K.CLIP_CHARS - len(query)) // 2
    wanted = F.greatest(F.lit(0), F.position(needle, hay) - 1 - lead)
    begin = F.greatest(F.lit(0), F.least(wanted, size - K.CLIP_CHARS))
    window = F.concat(
        F.when(begin > 0, F.lit("...")).otherwise(F.lit("")),
        F.substr(line, begin + 1, F.lit(K.CLIP_CHARS)),
        F.when(begin + K.CLIP_CHARS < size, F.lit("...")).otherwise(F.lit("")),
    )
    return F.when(is_long(line), window).otherwise(line)
