"""Language identification with rank-order n-gram profiles.

A profile is the list of a language's most frequent character n-grams (n = 1 to 3,
ordered by count, ties by code). A document gets the language whose profile is nearest
by the out-of-place distance: the sum, over the document's own most frequent n-grams, of
the rank differences, where an n-gram that the profile lacks costs the profile's length.

Texts are lower-cased; every run of non-letters is one blank and a blank stands at both
ends. All counts cover whole texts and, for the profiles, all training rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from inkwell.llm.common import remainder, small_batches

PROFILE_SIZE = 300
MAX_LANGUAGES = 1000
BLOCK = 1 << 20
FLUSH = 1 << 20
BLANK = 32
NONE = "und"


def _letters() -> np.ndarray:
    """Which code points are letters, as a table made once per process."""
    if not hasattr(_letters, "table"):
        _letters.table = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters.table


def _symbols(text: str) -> np.ndarray:
    """Code points with each run of non-letters as one blank, and a blank at both ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = np.concatenate(([False], _letters()[points], [False]))
    points = np.concatenate(([BLANK], points, [BLANK]))
    points = np.where(letter, points, BLANK)
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]
    return points[keep].astype(np.int64)


def _unique(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and their counts."""
    values = np.sort(values)
    first = np.flatnonzero(np.concatenate(([True] * min(1, len(values)), values[1:] != values[:-1])))
    return values[first], np.diff(np.append(first, len(values)))


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    counts = np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)
    return codes, counts


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes and counts of the 1-, 2- and 3-grams; no n-gram spans a blank inside."""
    s = _symbols(text)
    if len(s) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    parts = []
    for at in range(0, len(s), BLOCK):
        c = s[at : at + BLOCK + 2]
        one = c[:BLOCK]
        two = (c[:-1] << 21 | c[1:])[:BLOCK]
        three = (c[:-2] << 42 | c[1:-1] << 21 | c[2:])[c[1:-1] != BLANK] if len(c) > 2 else c[:0]
        parts.append(_unique(np.concatenate((one[one != BLANK], two, three))))
    return parts[0] if len(parts) == 1 else _merge(parts)


def top_codes(codes: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """The k most frequent codes in rank order; ``codes`` is sorted, so ties go by code."""
    top = counts.max(initial=0)
    key = (top - counts).astype(np.uint16) if top < 65536 else top - counts
    return codes[np.argsort(key, kind="stable")[:k]]


@dataclass(frozen=True)
class Profiles:
    languages: list[str]
    codes: np.ndarray  # sorted codes that any profile has
    ranks: np.ndarray  # by code and language; the profile's length where it lacks the code
    size: int

    def predict(self, text: str) -> tuple[str, float]:
        """Nearest language (ties to the smaller name) and 1 - distance / largest distance."""
        own = top_codes(*ngram_counts(text), self.size)
        if not len(own) or not self.languages:
            return NONE, 0.0
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        known = self.codes[at] == own
        place = np.arange(len(own))[:, None]
        distance = np.where(known[:, None], np.abs(self.ranks[at] - place), self.size).sum(0)
        best = int(np.argmin(distance))
        return self.languages[best], float(1 - distance[best] / (self.size * len(own)))


def learn_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE_SIZE) -> Profiles:
    """Count the n-grams of all rows that have text and language; keep each language's most frequent.

    Tasks add up their own counts before the shuffle. What reaches the driver is ``size``
    rows per language; more than MAX_LANGUAGES languages are an error.
    """
    small_batches(docs.sparkSession)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        n = 0

        def out() -> Iterator[pa.RecordBatch]:
            for name, parts in held.items():
                codes, total = _merge(parts)
                yield pa.record_batch([pa.array([name] * len(codes), pa.string()), pa.array(codes), pa.array(total)], ["lang", "code", "n"])

        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for t, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by_lang.setdefault(name, []).append(t)
            for name, rows in by_lang.items():
                parts = [ngram_counts(t) for t in rows]
                held[name] = [_merge(held.get(name, []) + parts)]
            n = sum(len(p[0][0]) for p in held.values())
            if n > FLUSH:
                yield from out()
                held = {}
        yield from out()

    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    totals = rows.mapInArrow(counts, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    # compared as it is, the row number limits every task's rows of a language before they meet
    best = totals.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    kept = best.select("lang", "code", (F.col("rank") - 1).alias("rank"))
    found = kept.limit(MAX_LANGUAGES * size + 1).toPandas()
    languages = sorted(found["lang"].unique())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    codes = np.unique(found["code"].to_numpy(np.int64))
    ranks = np.full((len(codes), len(languages)), size, np.int64)
    if len(found):
        ranks[np.searchsorted(codes, found["code"].to_numpy()), np.searchsorted(languages, found["lang"])] = found["rank"]
    return Profiles(languages, codes, ranks, size)


def identify(docs: DataFrame, profiles: Profiles, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns of every row with lang_pred and score. No shuffle.

    A null or letterless text is `und` with score 0.
    """
    small_batches(docs.sparkSession)
    kept = docs.select(*keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", lang_pred string, score double"

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.predict(t or "") for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())],
                names=[*keep, "lang_pred", "score"],
            )

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(predict, schema)


def language_query(docs: DataFrame, size: int = PROFILE_SIZE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each document.

    Held out is crc32(doc_id as text) mod 4 = 2; those rows teach nothing. A null doc_id
    has no remainder: it is neither held out nor learnt from. Repeated rows count as often
    as they occur and are all returned. Without training rows all is `und`, score 0.
    """
    part = remainder(F.col("doc_id"), 4)
    profiles = learn_profiles(docs.where(part != 2), size=size)
    rows = docs.select("doc_id", F.coalesce(part == 2, F.lit(False)).alias("held_out"), "text")
    return identify(rows, profiles, ["doc_id", "held_out"])
