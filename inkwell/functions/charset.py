"""Bytes to text: byte order marks, UTF-8, declared and assumed one-byte encodings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

LATIN = ("iso-8859-1", "latin1", "latin-1", "iso_8859-1", "us-ascii", "ascii")
WINDOWS = ("windows-1252", "cp1252", "x-cp1252")
# what the bytes 80 to 9f mean in windows-1252; the five unused ones stay control characters
_CONTROLS = "".join(map(chr, range(0x80, 0xA0)))
_MARKS = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0))
DECLARED = r"""(?i)<(?:meta[^>]+charset|\?xml[^>]+encoding)\s*=\s*["']?\s*([\w.:-]+)"""


def latin(content: Column) -> Column:
    return F.decode(content, "ISO-8859-1")


def windows_1252(content: Column) -> Column:
    return F.translate(latin(content), _CONTROLS, _MARKS)


def decoded(content: Column, declared: bool = False, fallback: str | None = "windows-1252") -> Column:
    """Text of a file's bytes without its byte order mark.

    In this order: a UTF-8 or UTF-16 byte order mark; valid UTF-8; with ``declared`` the
    one-byte encoding that an HTML or XML file names; ``fallback`` (``windows-1252``,
    ``iso-8859-1`` or None). NULL if nothing applies. Broken units after a UTF-16 mark
    become U+FFFD, which needs ``spark.sql.legacy.codingErrorAction`` (see session).
    """
    if fallback is not None and fallback.lower() not in LATIN + WINDOWS:
        raise ValueError(f"no expression for {fallback}")
    mark = F.hex(F.substring(content, 1, 3))
    utf8 = F.when(mark == "EFBBBF", F.substring(content, 4, F.octet_length(content))).otherwise(content).cast("string")
    rest = F.substring(content, 3, F.octet_length(content))
    text = (
        F.when(mark.startswith("FFFE"), F.decode(rest, "UTF-16LE"))
        .when(mark.startswith("FEFF"), F.decode(rest, "UTF-16BE"))
        .when(F.is_valid_utf8(utf8), utf8)
    )
    if declared:
        name = F.lower(F.regexp_extract(latin(content), DECLARED, 1))
        text = text.when(name.isin(*LATIN, *WINDOWS), windows_1252(content))  # browsers read both the same way
    if fallback is not None:
        text = text.otherwise(windows_1252(content) if fallback.lower() in WINDOWS else latin(content))
    return text
