"""Content types by file extension, with magic bytes for files without one."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Extension -> content type.
MIME_BY_EXTENSION = {
    "csv": "text/csv",
    "doc": "application/msword",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "epub": "application/epub+zip",
    "htm": "text/html",
    "html": "text/html",
    "json": "application/json",
    "log": "text/plain",
    "md": "text/markdown",
    "odp": "application/vnd.oasis.opendocument.presentation",
    "ods": "application/vnd.oasis.opendocument.spreadsheet",
    "odt": "application/vnd.oasis.opendocument.text",
    "pdf": "application/pdf",
    "ppt": "application/vnd.ms-powerpoint",
    "pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "rtf": "application/rtf",
    "tsv": "text/tab-separated-values",
    "txt": "text/plain",
    "xhtml": "application/xhtml+xml",
    "xls": "application/vnd.ms-excel",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "xml": "application/xml",
    "zip": "application/zip",
}

PLAIN_TYPES = (
    "text/plain", "text/csv", "text/tab-separated-values", "text/markdown",
    "application/json", "application/xml",
)
# white space, byte order mark, prolog and comments of any length may come first
HTML_START = r"(?is)\A\x{FEFF}?\s*+(?:<\?xml.*?\?>\s*+|<!--.*?-->\s*+)*+<(?:!doctype\s|html[\s>])"
HTML_TYPES = ("text/html", "application/xhtml+xml")


def extension(name: Column) -> Column:
    """Lower-case extension of the last path element, '' without one."""
    return F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)\z", 1))


def mime_from_name(name: Column) -> Column:
    """Content type by extension, NULL when unknown.

    A literal map keeps the lookup inside the scan stage and works on streams.
    """
    table = F.create_map(*[F.lit(x) for kv in MIME_BY_EXTENSION.items() for x in kv])
    return F.try_element_at(table, extension(name))


def mime_from_bytes(content: Column) -> Column:
    """Content type by leading bytes; any other valid UTF-8 counts as plain text."""
    head = F.hex(F.substring(content, 1, 5))
    page = content.cast("string").rlike(HTML_START)
    return (
        F.when(head.startswith("255044462D"), F.lit("application/pdf"))
        .when(head.startswith("504B0304"), F.lit("application/zip"))
        .when(head.startswith("7B5C727466"), F.lit("application/rtf"))
        .when(page, F.lit("text/html"))
        .when(F.is_valid_utf8(content.cast("string")), F.lit("text/plain"))
    )


def content_type(name: Column, content: Column) -> Column:
    return F.coalesce(mime_from_name(name), mime_from_bytes(content))
