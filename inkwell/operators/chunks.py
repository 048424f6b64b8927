"""Splitting text into ordered chunks of a bounded size.

Splitting happens inside the row that holds the document: a regular expression cuts
the text into windows, array functions number and clean them, and one generator
emits the chunks. The text is never shuffled.

Rules (sizes in characters, four per token):

1. A window takes at most ``budget`` characters and ends after its last ``.``, ``?``,
   ``!`` or newline, if that lies beyond ``min_chars``. Without one it is a full window.
2. Blank windows are skipped; every other one, trimmed, is a chunk.

So no text is lost, no chunk is longer than the budget, and texts of all sizes follow the
same rule. Two options of the caller, both off by default, change that: ``min_len`` leaves
out chunks not longer than it (:func:`left_out` counts what goes), and ``max_chunks`` puts
all text after that many chunks into one closing chunk on a single line (``overflow``).

Windows concatenate to exactly the input text.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from inkwell.functions import text as TX

CHARS_PER_TOKEN = 4
TERMINATORS = ".?!\n"


class ChunkParams(NamedTuple):
    budget: int
    min_chars: int
    min_len: int = 0
    max_chunks: int | None = None


class _Rule(NamedTuple):
    bytes_per_token: int
    low: int
    high: int
    least_min: int
    least_len: int
    max_chunks: int


# Parameter rules for normal and large files.
NORMAL_RULE = _Rule(bytes_per_token=4, low=1000, high=2000, least_min=100, least_len=20, max_chunks=1000)
LARGE_RULE = _Rule(bytes_per_token=8, low=500, high=1000, least_min=50, least_len=10, max_chunks=500)


def rule_columns(chunk_size: Column, large: Column) -> dict[str, Column]:
    """tokens, min_chars, min_len, max_chunks as columns; all divisions are integer.

    The last two are what a caller may pass as options; :func:`params_for` leaves them off.
    """

    def pick(field: str) -> Column:
        return F.when(large, F.lit(getattr(LARGE_RULE, field))).otherwise(F.lit(getattr(NORMAL_RULE, field)))

    def div(a: Column, b: Column) -> Column:
        return F.call_function("div", a, b).cast("int")

    tokens = F.greatest(pick("low"), F.least(pick("high"), div(chunk_size, pick("bytes_per_token"))))
    return {
        "tokens": tokens,
        "min_chars": F.greatest(pick("least_min"), div(tokens, F.lit(10))),
        "min_len": F.greatest(pick("least_len"), div(tokens, F.lit(50))),
        "max_chunks": pick("max_chunks"),
    }


def params_for(chunk_size: int, rule: str = "normal") -> ChunkParams:
    """Window sizes by a rule that the caller names (``normal`` or ``large``)."""
    r = {"normal": NORMAL_RULE, "large": LARGE_RULE}[rule]
    tokens = max(r.low, min(r.high, chunk_size // r.bytes_per_token))
    return ChunkParams(tokens * CHARS_PER_TOKEN, max(r.least_min, tokens // 10))


def _windows(text: Column, p: ChunkParams, terminators: str) -> Column:
    stop = "[" + "".join("\\n" if c == "\n" else "\\" + c for c in terminators) + "]"
    blank = TX.CONTROL_AND_SPACE
    parts = [rf"{blank}{{{p.budget}}}", rf"{blank}{{1,{p.budget}}}\z"]
    if p.budget - 1 > p.min_chars:
        # greedy: backtracks from the end of the window to its last terminator
        parts.append(rf".{{{p.min_chars + 1},{p.budget - 1}}}{stop}")
    parts.append(rf".{{1,{p.budget}}}")
    return F.regexp_extract_all(text, F.lit("(?s)" + "|".join(parts)), F.lit(0))


def _trim(text: Column) -> Column:
    return F.btrim(text, F.lit("".join(map(chr, range(0x21)))))


def split_text(text: Column, p: ChunkParams, terminators: str = TERMINATORS) -> Column:
    """``array<struct<text, overflow>>`` of one text, NULL text gives an empty array."""
    indexed = F.transform(
        _windows(F.coalesce(text, F.lit("")), p, terminators),
        lambda w, i: F.struct(i.alias("i"), w.alias("w")),
    )

    def pieces(windows: Column) -> Column:
        filled = F.filter(windows, lambda x: ~TX.is_blank_trimmed(x["w"]))
        return F.transform(
            F.array(F.struct(windows.alias("all"), filled.alias("filled"))), lambda s: _assemble(s, p)
        )[0]

    # bind the windows once: lambda variables are evaluated a single time
    return F.transform(F.array(indexed), pieces)[0]


def _assemble(s: Column, p: ChunkParams) -> Column:
    counted = s["filled"] if p.max_chunks is None else F.slice(s["filled"], 1, p.max_chunks)
    chunks = F.transform(counted, lambda x: F.struct(_trim(x["w"]).alias("text"), F.lit(False).alias("overflow")))
    if p.max_chunks is not None:
        over = F.size(s["filled"]) > p.max_chunks
        last = F.try_element_at(s["filled"], F.lit(p.max_chunks))["i"]
        rest = F.array_join(F.transform(F.filter(s["all"], lambda x: x["i"] > last), lambda x: x["w"]), "")
        tail = F.struct(_trim(F.translate(rest, "\n", " ")).alias("text"), F.lit(True).alias("overflow"))
        closing = F.filter(F.array(tail), lambda c: F.length(c["text"]) > 0)
        chunks = F.when(over, F.concat(chunks, closing)).otherwise(chunks)
    return F.filter(chunks, lambda c: F.length(c["text"]) > p.min_len) if p.min_len else chunks


def left_out(text: Column, p: ChunkParams) -> Column:
    """Characters of the trimmed chunks that ``min_len`` leaves out of one text."""
    short = F.filter(split_text(text, p._replace(min_len=0)), lambda c: F.length(c["text"]) <= p.min_len)
    return F.aggregate(short, F.lit(0).cast("long"), lambda n, c: n + F.length(c["text"]))


def split_pages(pages: Column, p: ChunkParams, terminators: str = TERMINATORS) -> Column:
    """``array<struct<page_no, text, overflow>>``; blank pages give nothing."""
    per_page = F.transform(
        pages,
        lambda page, n: F.transform(
            split_text(page, p, terminators),
            lambda c: F.struct((n + 1).alias("page_no"), c["text"].alias("text"), c["overflow"].alias("overflow")),
        ),
    )
    return F.flatten(per_page)


def chunk_text(df: DataFrame, pages: str, p: ChunkParams, keep: list[str], terminators: str = TERMINATORS) -> DataFrame:
    """One row per chunk: ``keep`` columns, page_no, chunk_no, n_chunks, text, overflow."""
    return _emit(df.select(*keep, split_pages(F.col(pages), p, terminators).alias("_c")), keep)


def _emit(arrays: DataFrame, keep: list[str]) -> DataFrame:
    # the outer generator: a plain one would add a size filter below the projection
    # and split every text twice
    rows = arrays.select(*keep, F.size("_c").alias("n_chunks"), F.posexplode_outer("_c").alias("_pos", "_chunk"))
    return rows.where(F.col("_pos").isNotNull()).select(
        *keep,
        F.col("_chunk.page_no").alias("page_no"),
        (F.col("_pos") + 1).alias("chunk_no"),
        "n_chunks",
        F.col("_chunk.text").alias("text"),
        F.col("_chunk.overflow").alias("overflow"),
    )


def report_of(chunks: Column) -> Column:
    """``=== CHUNK i OF n ===`` report of an array of chunk texts."""
    n = F.size(chunks).cast("string")
    return F.array_join(
        F.transform(
            chunks,
            lambda c, i: F.concat(F.lit("=== CHUNK "), (i + 1).cast("string"), F.lit(" OF "), n, F.lit(" ===\n"), c, F.lit("\n\n")),
        ),
        "",
    )


def ordered_texts(chunks: DataFrame, doc: str) -> DataFrame:
    """Array of chunk texts per document from a stored chunk table, in chunk order.

    A group is one document, which came from a single row, so it stays bounded.
    """
    return chunks.groupBy(doc).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("chunk_no", "text"))), lambda c: c["text"]).alias("texts")
    )


def chunk_report(chunks: DataFrame, doc: str) -> DataFrame:
    return ordered_texts(chunks, doc).select(doc, report_of(F.col("texts")).alias("report"))


def rejoin_chunks(chunks: DataFrame, doc: str) -> DataFrame:
    return ordered_texts(chunks, doc).select(doc, F.array_join("texts", "").alias("text"))


def page_diagnostics(df: DataFrame, pages: str, keep: list[str]) -> DataFrame:
    """Length and one-line snippets of every page."""
    # the outer generator keeps Spark from splitting the text again for a size filter
    rows = df.select(*keep, F.posexplode_outer(pages).alias("page_no", "_t")).where(F.col("page_no").isNotNull())
    return rows.select(
        *keep,
        "page_no",
        F.coalesce(F.length("_t"), F.lit(0)).alias("n_chars"),
        TX.snippet(F.col("_t"), 300).alias("snippet_300"),
        TX.snippet(F.col("_t"), 150).alias("snippet_150"),
    )
