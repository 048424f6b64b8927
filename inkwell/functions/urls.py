"""File names and paths taken from URLs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

STORE_MARKER = "/webhdfs/v1/"


def stream_filename(url: Column) -> Column:
    """Decoded text after the last slash, query string included; NULL if undecodable."""
    return F.try_url_decode(F.substring_index(url, "/", -1))


def file_key(url: Column) -> Column:
    return F.sha2(url, 256)


def with_open_op(url: Column) -> Column:
    """Append ``op=OPEN`` once, as first or as further query parameter."""
    return F.when(F.contains(url, F.lit("op=OPEN")), url).otherwise(
        F.concat(url, F.when(F.contains(url, F.lit("?")), F.lit("&")).otherwise(F.lit("?")), F.lit("op=OPEN"))
    )


def encode_once(name: Column) -> Column:
    """Form-encode unless the name already carries a percent escape."""
    return F.when(F.contains(name, F.lit("%")), name).otherwise(F.url_encode(name))


def fetch_filename(url: Column) -> Column:
    """Text after the last slash of the opened URL, without the query string."""
    return F.substring_index(F.substring_index(with_open_op(url), "/", -1), "?", 1)


def fetch_url(url: Column) -> Column:
    """URL to read the bytes from: ``op=OPEN`` set, file name encoded exactly once."""
    opened = with_open_op(url)
    tail = F.substring_index(opened, "/", -1)
    name = F.substring_index(tail, "?", 1)
    head = F.left(opened, F.length(opened) - F.length(tail))
    query = F.right(tail, F.length(tail) - F.length(name))
    return F.concat(head, encode_once(name), query)


def store_base(url: Column) -> Column:
    """URL cut right after the storage API root; unchanged without one."""
    return F.when(
        F.contains(url, F.lit(STORE_MARKER)),
        F.concat(F.substring_index(url, STORE_MARKER, 1), F.lit(STORE_MARKER.rstrip("/"))),
    ).otherwise(url)


def output_path(url: Column, filename: Column, encode: bool = True, folder: str = "processed_files") -> Column:
    """Where the extracted text of ``filename`` goes, next to its storage root."""
    name = F.url_encode(filename) if encode else filename
    return F.concat(store_base(url), F.lit(f"/{folder}/"), name, F.lit(".txt"))


def local_output_path(output_dir: str, filename: Column) -> Column:
    """Directory-batch variant: the plain file name plus ``.txt``."""
    return F.concat(F.lit(output_dir.rstrip("/") + "/"), filename, F.lit(".txt"))


def storage_path(url: Column) -> Column:
    """Hadoop path of a REST storage URL (``http://host:port/webhdfs/v1/p`` -> ``/p``).

    Other schemes keep their URL. The query string never belongs to the path. Only
    percent escapes are decoded: in a path ``+`` is a plus sign. NULL if undecodable.
    """
    plain = F.substring_index(url, "?", 1)
    path = F.when(
        F.contains(plain, F.lit(STORE_MARKER)),
        F.concat(F.lit("/"), F.substring(plain, F.locate(STORE_MARKER, plain) + F.lit(len(STORE_MARKER)), F.length(plain))),
    ).otherwise(plain)
    return F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
