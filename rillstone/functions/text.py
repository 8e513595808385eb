"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def literal_pattern(text: str) -> str:
    """A regular expression for the text itself. One character stays one (escaped) character, which
    Java splits on without compiling a pattern per row."""
    if len(text) == 1:
        return "\\" + text if text in ".$|()[]{}^?*+\\" else text
    return "\\Q" + text + "\\E"


def words(line: Column, sep: str = " ") -> Column:
    """Words of a line between single separators: inner empties stay, trailing empties go.

    An empty line is one empty word; a line of separators only has no words.
    """
    pattern = literal_pattern(sep)
    text = F.rtrim(line) if sep == " " else F.regexp_replace(line, f"(?:{pattern})+$", "")
    return (
        F.when(line == "", F.array(F.lit("")))
        .when(text == "", F.array().cast("array<string>"))
        .otherwise(F.split(text, pattern, -1))
    )


def concat_with(sep: Column | str, left: Column, right: Column) -> Column:
    """``left + sep + right``; NULL if any part is NULL (``concat_ws`` would skip it)."""
    return F.concat(left, F.lit(sep) if isinstance(sep, str) else sep, right)


def ip_number(ip: Column) -> Column:
    """Dotted address to number, most significant byte first."""
    part = F.split(ip, "\\.", -1)
    value = F.lit(0).cast("bigint")
    for i in range(4):
        value = value * 256 + F.get(part, i).try_cast("bigint")
    return value


def number_ip(number: Column) -> Column:
    """The inverse of :func:`ip_number`."""
    octets = [F.shiftright(number, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]
    return F.concat_ws(".", *octets)
