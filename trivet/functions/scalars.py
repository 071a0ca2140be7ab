"""Small text and number functions of capture metadata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fourcc(code: Column) -> Column:
    """The four characters of a codec number, lowest byte first; blanks and unprintables are ?."""
    chars = [F.shiftright(code, 8 * i).bitwiseAND(255) for i in range(4)]
    text = F.concat(*[F.when(((c > 32) & (c < 127)) | ((c > 160) & (c != 173)), F.char(c)).otherwise("?") for c in chars])
    return F.when((code <= 0) | code.isNull() | (text == "????"), "unknown").otherwise(text)


def run_id(stamp: Column, name: Column) -> Column:
    """A time stamp and a name reduced to letters, digits, _ and -."""
    return F.concat_ws("_", F.date_format(stamp, "yyyyMMdd_HHmmss"), F.regexp_replace(name, "[^a-zA-Z0-9_-]", "_"))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(file_name(path), r".(\.[^.]+)$", 1))


def frame_name(index: Column) -> Column:
    return F.format_string("frame_%06d.jpg", index)
