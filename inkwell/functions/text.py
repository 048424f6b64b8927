"""Text predicates and small text projections, all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The two whitespace classes that decide "blank".
CONTROL_AND_SPACE = r"[\x00-\x20]"
UNICODE_SPACE = (
    r"[\t-\r\x1c-\x20\x{1680}\x{2000}-\x{2006}\x{2008}-\x{200a}\x{2028}\x{2029}\x{205f}\x{3000}]"
)


def is_blank_trimmed(text: Column) -> Column:
    """True for NULL or text made only of characters up to U+0020."""
    # \A..\z: `$` would also match before a trailing U+2028 or U+0085
    return text.isNull() | text.rlike(rf"\A{CONTROL_AND_SPACE}*\z")


def is_blank_unicode(text: Column) -> Column:
    """True for NULL or text made only of Unicode whitespace (no-break spaces excluded)."""
    return text.isNull() | text.rlike(rf"\A{UNICODE_SPACE}*\z")


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units; ``length`` counts code points."""
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("long")


def snippet(text: Column, size: int) -> Column:
    """First ``size`` characters on one line: cut first, then flatten newlines."""
    return F.translate(F.substring(text, 1, size), "\n", " ")


def safe_name(name: Column) -> Column:
    """File name with everything outside ``[a-zA-Z0-9._-]`` replaced by ``_``."""
    return F.regexp_replace(name, "[^a-zA-Z0-9._-]", "_")


def dump_name(name: Column, kind: str = "extracted", prefix: str = "") -> Column:
    """Name of the dump file for one document, ``kind`` is extracted or chunked."""
    return F.concat(F.lit(prefix), safe_name(name), F.lit(f"_{kind}.txt"))


def join_pages(pages: Column, leading_separator: bool = True) -> Column:
    """Concatenate pages with an empty line between; a NULL page counts as empty.

    With ``leading_separator`` every page, the first one included, is preceded by
    the separator, which is the fold over an empty start value.
    """
    joined = F.array_join(F.transform(pages, lambda p: F.coalesce(p, F.lit(""))), "\n\n")
    if not leading_separator:
        return joined
    return F.when(F.size(pages) > 0, F.concat(F.lit("\n\n"), joined)).otherwise(F.lit(""))


def size_class(length: Column, threshold: int = 50 * 1024 * 1024) -> Column:
    """LARGE strictly above the threshold."""
    return F.when(length > F.lit(threshold), F.lit("LARGE")).otherwise(F.lit("NORMAL"))


def megabytes(length: Column) -> Column:
    return F.format_string("%.2f", length / F.lit(1024.0 * 1024.0))


def estimated_chunks(length: Column, chunk_size: int = 262144) -> Column:
    """Ceiling division in integers."""
    return F.call_function("div", length + F.lit(chunk_size - 1), F.lit(chunk_size))
