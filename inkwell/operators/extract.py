"""Text extraction: a MIME type picks an expression or an Arrow batch function."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from inkwell.functions import charset as CS, html as H, mime as MT, text as TX
from inkwell.session import configure

# Container formats, the archive members that hold text and the
# XML elements that end a paragraph or hold a tab.
MEMBERS = {
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": r"word/document\.xml",
    "application/vnd.openxmlformats-officedocument.presentationml.presentation": r"ppt/slides/slide\d+\.xml",
    "application/vnd.oasis.opendocument.text": r"content\.xml",
    "application/vnd.oasis.opendocument.presentation": r"content\.xml",
    "application/vnd.oasis.opendocument.spreadsheet": r"content\.xml",
    "application/epub+zip": r".*\.x?html?",
}
PARAGRAPHS = ("p", "h", "tr", "table-row", "div", "li", "br", "title")
GAPS = ("tab", "s", "tc", "table-cell", "td")

PageReader = Callable[[bytes], list[str]]


def _member_text(data: bytes) -> str:
    """Text of one XML member: a line per paragraph, a space per tab or cell."""
    parts: list[str] = []
    todo: list = [ElementTree.fromstring(data)]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            parts.append(item)
            continue
        name = item.tag.rsplit("}", 1)[-1] if isinstance(item.tag, str) else ""
        if name in PARAGRAPHS:
            todo.append("\n")
        elif name in GAPS:
            todo.append(" ")
        # a stack, so children go on in reverse and deep documents are no problem
        for child in reversed(item):
            todo += [child.tail or "", child]
        if name not in ("script", "style"):
            parts.append(item.text or "")
    return re.sub(r"\n{2,}", "\n", "".join(parts)).strip()


def _archive_pages(pattern: str) -> PageReader:
    def read(content: bytes) -> list[str]:
        def order(name: str):
            return [int(x) if x.isdigit() else x for x in re.split(r"(\d+)", name)]

        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            names = sorted((n for n in archive.namelist() if re.fullmatch(pattern, n)), key=order)
            return [_member_text(archive.read(n)) for n in names]

    return read


def default_readers() -> dict[str, PageReader]:
    """Readers of formats that need Python; others plug in by the caller."""
    return {mime: _archive_pages(pattern) for mime, pattern in MEMBERS.items()}


def _container_column(content: Column, mime: Column, readers: dict[str, PageReader]) -> Column:
    @F.pandas_udf("struct<pages: array<string>, error: string>")
    def read(content: pd.Series, mime: pd.Series) -> pd.DataFrame:
        pages, errors = [], []
        for data, kind in zip(content, mime):
            try:
                pages.append(None if data is None else readers[kind](bytes(data)))
                errors.append(None)
            except Exception as e:  # a bad document is a row outcome, not a failed task
                pages.append(None)
                errors.append(f"{type(e).__name__}: {e}")
        return pd.DataFrame({"pages": pages, "error": errors})

    # other rows send NULL, so their bytes never leave the JVM
    return read(F.when(mime.isin(*readers), content), mime)


def extract_pages(df: DataFrame, content: str = "content", mime: str = "mime",
                  readers: dict[str, PageReader] | None = None,
                  native: dict[str, Callable[[Column], Column]] | None = None,
                  fallback: str | None = "windows-1252") -> DataFrame:
    """Add ``pages ARRAY<STRING>`` and ``failure`` (outcome of unreadable rows, else NULL).

    Plain text and HTML are built-in expressions; further text formats plug in
    through ``native`` (MIME type to Column function) and binary ones through
    ``readers`` (MIME type to Python function). Pass ``readers={}`` to keep the plan
    free of Python. Encodings are those of :func:`inkwell.functions.charset.decoded`; with
    ``fallback=None`` bytes of no known encoding are UNDECODABLE.
    """
    configure(df.sparkSession)
    readers = default_readers() if readers is None else readers
    kind = F.col(mime)
    builders: dict[str, Callable[[Column], Column]] = {t: H.html_to_text for t in MT.HTML_TYPES}
    builders.update(native or {})
    decoded = F.when(kind.isin(*MT.HTML_TYPES), CS.decoded(F.col(content), True, fallback)).otherwise(CS.decoded(F.col(content), False, fallback))
    text_types = list(MT.PLAIN_TYPES) + list(builders)
    out = df.withColumn("_t", F.when(kind.isin(*text_types), decoded))
    text = F.when(kind.isin(*MT.PLAIN_TYPES), F.col("_t"))
    by_builder: dict[Callable, list[str]] = {}
    for t, build in builders.items():
        by_builder.setdefault(build, []).append(t)
    for build, types in by_builder.items():
        text = text.when(kind.isin(*types), build(F.col("_t")))
    if readers:
        out = out.withColumn("_r", _container_column(F.col(content), kind, readers))
    else:
        out = out.withColumn("_r", F.lit(None).cast("struct<pages: array<string>, error: string>"))
    failure = (
        F.when(kind.isin(*text_types), F.when(F.col("_t").isNull(), F.lit("UNDECODABLE")))
        .when(kind.isin(*readers), F.when(F.col("_r.error").isNotNull(), F.lit("PARSE_ERROR")))
        .otherwise(F.lit("UNSUPPORTED_FORMAT"))
    )
    return out.select(
        *df.columns,
        F.coalesce("_r.pages", F.when(F.col("_t").isNotNull(), F.array(text))).alias("pages"),
        F.when(F.col(content).isNotNull(), failure).alias("failure"),
        F.col("_r.error").alias("error_message"),
    )


def extract_text(df: DataFrame, name: str = "filename", content: str = "content", **kwargs) -> DataFrame:
    """Add mime, pages, failure and ``text``, the joined pages ('' when nothing came out)."""
    typed = df.withColumn("mime", MT.content_type(F.col(name), F.col(content)))
    return extract_pages(typed, content, "mime", **kwargs).withColumn(
        "text", F.coalesce(TX.join_pages(F.col("pages")), F.lit(""))
    )
