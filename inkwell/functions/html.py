"""HTML to text as a chain of regular expressions, evaluated in the JVM."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, functions as F

# Elements that break lines, elements whose content is not text (besides head).
BLOCKS = (
    "address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|header|hr|html"
    "|li|main|nav|ol|p|pre|section|table|tbody|td|th|thead|tr|ul"
)
UNSEEN = ("script", "style")
# the frequent ones first, because a map literal is searched in order; "nbsp" reads as a blank
COMMON = ("amp", "lt", "gt", "quot", "nbsp", "apos", "copy", "reg", "middot", "hellip", "ndash", "mdash")
ENTITIES = {n: html5[f"{n};"] for n in COMMON} | {n[:-1]: c for n, c in html5.items() if n.endswith(";")} | {"nbsp": " "}

# comments, unseen elements with their content, and all tags that do not break lines;
# every alternative begins at "<", so other characters are skipped at once. An unclosed
# comment, script or style runs to the end of the page, which also keeps the scan linear.
INLINE = (
    r"(?is)<(?:!--.*?(?:-->|\z)|head\b[^>]*>.*?</head\s*>|"
    + "|".join(rf"{name}\b[^>]*>.*?(?:</{name}\s*>|\z)" for name in UNSEEN)
    + rf"|(?!/?(?:{BLOCKS})\b)[a-z/!?][^>]*(?:>|\z))"
)
BREAKING = r"</?[a-zA-Z][^>]*(?:>|\z)"  # only block tags are left by then
SPACES = " \t\r\f\x0b\n"


def decode_entities(text: Column) -> Column:
    """Replace named and numeric character references, each exactly once.

    One split at ``&`` instead of one pass per entity; unknown references stay.
    """
    table = F.from_json(F.lit(json.dumps(ENTITIES)), "map<string,string>")  # folds to one literal

    def decoded(piece: Column) -> Column:
        name = F.substring_index(piece, ";", 1)
        code = F.when(
            name.rlike(r"\A#(?:0*[0-9]{1,7}|[xX]0*[0-9a-fA-F]{1,6})\z"),
            F.when(F.substring(name, 2, 1).isin("x", "X"), F.conv(F.substring(name, 3, F.length(name)), 16, 10))
            .otherwise(F.substring(name, 2, F.length(name)))
            .cast("int"),
        )
        in_range = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code <= 0x10FFFF))
        numeric = F.when(in_range, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        char = F.coalesce(F.try_element_at(table, name), numeric)
        return F.when(
            F.contains(piece, F.lit(";")) & char.isNotNull(), F.concat(char, F.substring(piece, F.length(name) + 2, F.length(piece)))
        ).otherwise(F.concat(F.lit("&"), piece))

    return F.array_join(F.transform(F.split(text, "&"), lambda p, i: F.when(i == 0, p).otherwise(decoded(p))), "")


def html_to_text(html: Column) -> Column:
    """Visible text of a page: one line per block element, single spaces."""
    text = F.regexp_replace(html, INLINE, "")
    text = F.regexp_replace(text, BREAKING, "\n")
    text = decode_entities(text)
    text = F.regexp_replace(text, r"[ \t\r\f\x0b]{2,}|[\t\r\f\x0b]", " ")
    text = F.regexp_replace(text, r"(?: \n|\n[ \n])[ \n]*", "\n")
    return F.btrim(text, F.lit(SPACES))
