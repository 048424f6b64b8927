"""Toxicity by a weighted lexicon.

Texts are folded (case, accents, look-alike letters, digits and signs that stand for
letters) to words between single blanks. An Aho-Corasick automaton finds lexicon entries:
whole words (" word ") and stems (" stem", any ending). In a run of letters and signs every
sign may be a letter or part words, so a second automaton searches such runs with all signs
read for entries that start and end beside a sign or at an edge. Each word counts once, with
its heaviest entry; words that an exception phrase covers do not count. The sum of weights,
plain and per 100 words, goes through a logistic function to a score.

Entries and weights are learnt from document counts of all words, and of stems over those
words, in rows labelled toxic and not. A term's weight is a lower confidence bound of its
log-odds, taken without one of its toxic documents (a stem's: without those of its most
frequent word), so what a single document says teaches nothing and tables of any size follow one rule. Every term whose bound reaches MIN_LOG_ODDS
is an entry; none is cut by rank. An entry with its neighbour word whose upper bound stays
below MIN_LOG_ODDS is an exception phrase. The logistic function is fitted on a table of binned features
of all labelled rows, whose size is bounded by the bins.

The lexicon is a table. It goes to the tasks in blocks of about BLOCK_BYTES of patterns:
with more than one block each is a pass over the texts, which hands on what it found.
"""

from __future__ import annotations

import math
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from inkwell.llm.common import free_name, quoted, remainder, small_batches, written

MIN_LOG_ODDS = 2.0
CONFIDENCE = 1.5  # standard deviations
BLOCK_BYTES = 4 << 20
STEMS = (4, 8)
FLUSH = 500_000
LABEL_BYTES = 16  # of one label in a broadcast table
BROADCAST_BYTES = 8 << 20

# Letters of other scripts that look like Latin ones, and their readings.
LOOKALIKE = dict(zip("авекмнорстухіјѕԁԛԝһαβεικνορτυχ", "abekmhopctyxijsdqwhabeikvoptux", strict=True))
# Digits and signs read as letters.
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"}
# Phrases in which a listed word is harmless.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "class clown", "pathetic fallacy")

BLANK = 32
DROPPED = 0
_SIGN_LETTERS = np.zeros(129, np.uint32)
for _sign, _letter in SIGNS.items():
    _SIGN_LETTERS[ord(_sign)] = ord(_letter)


def _plain(c: str) -> int:
    """The plain lower-case letter of a character; a blank for what is no letter, DROPPED for marks and invisible signs."""
    if unicodedata.category(c) in ("Cf", "Mn", "Me"):
        return DROPPED
    c = c.lower()
    c = LOOKALIKE.get(c, c)
    base = [x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)]
    x = base[0].lower() if base else " "
    return ord(x) if len(x) == 1 and x.isalpha() else BLANK


def _table() -> np.ndarray:
    """Folded code point of each code point, made once per process."""
    if not hasattr(_table, "made"):
        _table.made = np.fromiter((_plain(chr(i)) if not 0xD800 <= i < 0xE000 else BLANK for i in range(0x110000)), np.uint32, 0x110000)
    return _table.made


def _letters(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letter (or blank), reading as a sign (or 0) and character of each place, with a blank at both ends.

    Combining marks are kept only in composed form: texts are composed first.
    """
    if not text.isascii() and not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    raw = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    points = _table()[raw]
    if not text.isascii() and not points.all():
        raw, points = raw[points != DROPPED], points[points != DROPPED]
    return points, _SIGN_LETTERS[np.minimum(raw, 128)], raw


def _runs(points: np.ndarray, sign: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of letters and signs that holds both."""
    letter = points != BLANK
    edge = np.diff((letter | (sign > 0)).view(np.int8))
    start, end = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    letters, signs = (np.concatenate(([0], np.cumsum(x))) for x in (letter, sign > 0))
    both = (letters[end] > letters[start]) & (signs[end] > signs[start])
    return start[both], end[both]


def _inside(start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    step = np.zeros(n + 1, np.int8)
    step[start] += 1
    step[end] -= 1
    return np.cumsum(step[:-1]).astype(bool)


def _folded(points: np.ndarray, sign: np.ndarray, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[str, np.ndarray]:
    """The words of ``fold`` and the place of each of their characters."""
    if len(start):
        # signs are read throughout a run, but $ @ ! | at its end are punctuation first
        solid = (points != BLANK) | ((raw >= 48) & (raw <= 57))
        last = np.maximum.accumulate(np.where(solid, np.arange(len(points)), 0))
        points = np.where(_inside(start, last[end - 1] + 1, len(points)) & (sign > 0), sign, points)
    keep = points != BLANK
    keep[0] = True
    keep[1:] |= points[:-1] != BLANK
    return points[keep].tobytes().decode("utf-32-le", "surrogatepass"), np.flatnonzero(keep)


def fold(text: str) -> str:
    """Words in plain lower-case letters between single blanks, with a blank at both ends."""
    points, sign, raw = _letters(text)
    return _folded(points, sign, raw, *_runs(points, sign))[0]


def words_of(text: str) -> set[str]:
    """The words of a text, and its runs with every sign read."""
    points, sign, raw = _letters(text)
    start, end = _runs(points, sign)
    words = set(_folded(points, sign, raw, start, end)[0].split())
    if len(start):
        full = np.where(_inside(start, end, len(points)), np.where(sign > 0, sign, points), BLANK)
        words.update(full.astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass").split())
    return words


@dataclass(frozen=True)
class Lexicon:
    """``terms``: weight by pattern, " word " or " stem"; None for a learnt exception phrase.

    ``fit``: logistic coefficients. ``more``: further blocks of terms, each looked up in a pass of its own.
    """

    terms: dict[str, float | None]
    exceptions: tuple[str, ...] = EXCEPTIONS
    fit: tuple[float, float, float] = (-4.0, 1.0, 0.0)
    more: tuple[dict[str, float | None], ...] = ()

    def blocks(self) -> list[Lexicon]:
        return [Lexicon(self.terms, self.exceptions, self.fit), *(Lexicon(t, (), self.fit) for t in self.more)]

    def matcher(self):
        """Automata of ``terms`` over folded words and over runs of letters and signs."""
        import ahocorasick

        words, runs = ahocorasick.Automaton(), ahocorasick.Automaton()
        for pattern, weight in self.terms.items():
            words.add_word(pattern, (len(pattern), weight))
            if weight is None:
                continue
            bare, whole = pattern.strip(), pattern.endswith(" ")
            by_kind = runs.get(bare, (len(bare), 0.0, 0.0))[1:]
            runs.add_word(bare, (len(bare), *((max(by_kind[0], weight), by_kind[1]) if whole else (by_kind[0], max(by_kind[1], weight)))))
        for phrase in self.exceptions:
            pattern = fold(phrase)
            words.add_word(pattern, (len(pattern), None))
        for automaton in (words, runs):
            if len(automaton):
                automaton.make_automaton()
        return words, runs

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.fit[0] + x @ np.array(self.fit[1:])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


WORD, RUN, EXCUSED = 0.0, 1.0, 2.0
#: What was found: kind, place in the text, first and last character (of the run text for RUN, of the text for EXCUSED), weight.
Hit = tuple[float, int, int, int, float]


def _in_runs(automaton, points: np.ndarray, sign: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[Hit]:
    """Entries in runs of letters and signs, overlapping ones too."""
    within = _inside(start, end, len(points))
    within[end] = True  # a blank
    at = np.flatnonzero(within)
    mark = sign[at] > 0
    full = np.where(mark, sign[at], points[at])
    full[np.isin(at, end)] = BLANK
    edge = mark | (full == BLANK)  # what may stand before or after an entry
    edges = np.flatnonzero(edge)
    found = []
    for last, (length, word, stem) in automaton.iter(full.astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")):
        first = last - length + 1
        if first and not edge[first - 1]:
            continue
        weight = max(word if edge[last + 1] else 0.0, stem)
        if weight > 0:
            last = int(edges[np.searchsorted(edges, last + 1)]) - 1
            found.append((RUN, int(at[first]), first, last, weight))
    return found


def _hits(text: str, matcher) -> tuple[list[Hit], int]:
    """All that the automata find, and the number of words."""
    words, runs = matcher
    points, sign, raw = _letters(text)
    start, end = _runs(points, sign)
    folded, place = _folded(points, sign, raw, start, end)
    own = _inside(start, end, len(points)) if len(start) else None
    found: list[Hit] = []
    for last, (length, weight) in words.iter(folded) if len(words) else ():
        first = int(place[last - length + 2])
        if weight is None:
            found.append((EXCUSED, first, first, int(place[last]), 0.0))
        elif own is None or not own[first]:
            found.append((WORD, first, first, last, weight))
    if own is not None and len(runs):
        found += _in_runs(runs, points, sign, start, end)
    return found, max(1, folded.count(" ") - 1)


def _sums(hits: list[Hit], n: int) -> tuple[float, float]:
    """Of entries at one place, and of overlapping ones in runs, the heaviest counts, unless a phrase covers it."""
    best: dict[int, float] = {}
    taken: set[int] = set()
    for _, first, last, place, weight in sorted((-h[4], h[2], h[3], h[1], h[4]) for h in hits if h[0] == RUN):
        places = range(first, last + 1)
        if taken.isdisjoint(places):
            taken.update(places)
            best[place] = weight
    for kind, place, _, _, weight in hits:
        if kind == WORD and weight > best.get(place, 0.0):
            best[place] = weight
    starts: list[int] = []
    ends: list[int] = []
    for first, last in sorted((h[2], h[3]) for h in hits if h[0] == EXCUSED):
        if ends and first <= ends[-1]:
            ends[-1] = max(ends[-1], last)
        else:
            starts.append(first)
            ends.append(last)

    def excused(at: int) -> bool:
        i = bisect_right(starts, at) - 1
        return i >= 0 and at < ends[i]

    total = sum(w for at, w in sorted(best.items()) if not excused(at))
    return math.log1p(total), math.log1p(100 * total / n)


def weigh(text: str, matcher) -> tuple[float, float]:
    """log1p of the sum of weights, and of the sum per 100 words."""
    return _sums(*_hits(text, matcher)) if len(matcher[0]) else (0.0, 0.0)


def _counts(batches: Iterator[pa.RecordBatch], terms: Callable[[str], set[str]]) -> Iterator[pa.RecordBatch]:
    """Documents that have a term, toxic and not, added up by task."""
    held = (Counter(), Counter())

    def out() -> pa.RecordBatch:
        words = list(held[0].keys() | held[1].keys())
        return pa.record_batch([pa.array(words, pa.string()), *(pa.array([c[w] for w in words], pa.int64()) for c in held)], ["word", "clean", "toxic"])

    for batch in batches:
        for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held[y].update(terms(t or ""))
        if len(held[0]) + len(held[1]) > FLUSH:
            yield out()
            held = (Counter(), Counter())
    yield out()


def _phrases(text: str, words) -> set[str]:
    """Entries that are whole words or stems, each with the word before and with the word after it, as patterns."""
    points, sign, raw = _letters(text)
    folded = _folded(points, sign, raw, *_runs(points, sign))[0]
    found = set()
    for last, (length, _) in words.iter(folded):
        first = last - length + 1  # the blank before the entry
        end = folded.find(" ", first + 1)
        if first > 0:
            found.add(folded[folded.rfind(" ", 0, first) : end + 1])
        if end + 1 < len(folded):
            found.add(folded[first : folded.find(" ", end + 1) + 1])
    return found


def _bound(toxic: Column, clean: Column, base: float, side: int) -> Column:
    """Lower (-1) or upper (1) Wilson bound of a term's toxic share, as log-odds over those of ``base``."""
    n, z = toxic + clean, CONFIDENCE
    p = toxic / n
    share = (p + z * z / (2 * n) + side * z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    share = F.least(F.greatest(share, F.lit(1e-9)), F.lit(1 - 1e-9))
    return F.log(share / (1 - share)) - math.log(base / (1 - base))


def _entries(counts: DataFrame, base: float) -> DataFrame:
    """pattern, weight: stems, and the words that no stem covers.

    Of stems those are kept that no stem longer by a letter has nearly the support of, and
    of the kept ones the shortest.
    """
    lower = lambda df, left: df.where(left > 0).withColumn("weight", _bound(left, F.col("clean"), base, -1)).where(F.col("weight") >= MIN_LOG_ODDS)
    heads = lambda word, low, high: F.explode(F.transform(F.sequence(F.lit(low), high), lambda n: F.substr(word, F.lit(1), n)))
    word, short, tall = F.col("word"), *STEMS
    long_words = counts.where(F.length(word) > short)
    stems = (
        long_words.select("toxic", "clean", heads(word, short, F.least(F.length(word) - 1, F.lit(tall))).alias("word")).groupBy("word")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"), F.sum((F.col("toxic") > 0).cast("int")).alias("kinds"), F.max("toxic").alias("most"))
        .where("kinds >= 4 and most <= 0.5 * toxic")
    )
    stems = written(lower(stems, F.col("toxic") - F.col("most")).select("word", "toxic", "weight"), "stems")
    longer = stems.where(F.length(word) > short).groupBy(F.substr(word, F.lit(1), F.length(word) - 1).alias("word")).agg(F.max("toxic").alias("_longer"))
    kept = stems.join(longer, "word", "left").where("_longer is null or _longer < 0.9 * toxic").select("word", "weight")
    heads_of_kept = kept.select("word", heads(word, short, F.length(word) - 1).alias("head")) if tall > short else kept.select("word", F.lit("").alias("head"))
    inner = heads_of_kept.where(F.length("head") < F.length("word")).join(kept.select(F.col("word").alias("head")), "head", "left_semi")
    kept = written(kept.join(inner, "word", "left_anti"), "stems")
    words = lower(counts, F.col("toxic") - 1).select("word", "weight")
    covered = (
        words.where(F.length(word) >= short).select("word", heads(word, short, F.least(F.length(word), F.lit(tall))).alias("head"))
        .join(kept.select(F.col("word").alias("head")), "head", "left_semi")
    )
    words = words.join(covered, "word", "left_anti")
    return kept.select(F.concat(F.lit(" "), word).alias("pattern"), "weight").unionByName(words.select(F.concat(F.lit(" "), word, F.lit(" ")).alias("pattern"), "weight"))


def _blocks(entries: DataFrame, exceptions: tuple[str, ...], block_bytes: int) -> Lexicon:
    """Entries dealt by hash into blocks of about ``block_bytes``."""
    size = entries.agg(F.coalesce(F.sum(F.octet_length("pattern")), F.lit(0))).first()[0]
    n = max(1, -(-size // block_bytes))
    parts = [{r.pattern: r.weight for r in entries.where(F.pmod(F.xxhash64("pattern"), F.lit(n)) == i).orderBy("pattern").collect()} for i in range(n)]
    return Lexicon(parts[0], exceptions, more=tuple(parts[1:]))


def _with_features(docs: DataFrame, lexicon: Lexicon, text: str, use: Callable[[pa.RecordBatch, list[tuple[float, float]]], pa.RecordBatch], schema) -> DataFrame:
    """``use`` on each batch (the columns of ``docs``) with the two sums of each text; further blocks are earlier passes."""
    own, at = docs.columns, docs.columns.index(text)
    blocks = lexicon.blocks()
    held = free_name(docs, "hits") if len(blocks) > 1 else None

    def found(batch: pa.RecordBatch, matcher) -> list[tuple[list[Hit], int]]:
        out = [_hits(t or "", matcher) for t in batch.column(at).to_pylist()]
        if batch.num_columns > len(own):
            for (hits, _), flat in zip(out, batch.column(len(own)).to_pylist(), strict=True):
                hits.extend((flat[i], *map(int, flat[i + 1 : i + 4]), flat[i + 4]) for i in range(0, len(flat), 5))
        return out

    for block in blocks[1:]:

        def gathered(batches: Iterator[pa.RecordBatch], block: Lexicon = block) -> Iterator[pa.RecordBatch]:
            matcher = block.matcher()
            for batch in batches:
                flat = [[float(x) for h in hits for x in h] for hits, _ in found(batch, matcher)]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(own)], pa.array(flat, pa.list_(pa.float64()))], names=[*own, held])

        docs = docs.mapInArrow(gathered, docs.select(*map(quoted, own)).withColumn(held, F.array(F.lit(0.0))).schema)

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = blocks[0].matcher()
        for batch in batches:
            sums = [_sums(*x) for x in found(batch, matcher)]
            yield use(batch.select(list(range(len(own)))), sums)

    return docs.mapInArrow(finished, schema)


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float, float]:
    """Weighted ridge logistic regression by Newton steps, halved until they lower the loss."""
    x = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(x.shape[1])

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float((n * (np.logaddexp(0, z) - y * z)).sum() + 5e-3 * (b[1:] ** 2).sum())

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (n * (y - p)) - 1e-2 * b * [0, 1, 1]
        h = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag([1e-6, 1e-2, 1e-2])
        step = np.linalg.solve(h, g)
        step, now = step * min(1.0, 5 / max(1e-9, np.abs(step).max())), loss(b)
        for _ in range(40):
            if loss(b + step) <= now:
                break
            step = step / 2
        b = b + step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in b)


def learn_lexicon(labelled: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS, block_bytes: int = BLOCK_BYTES) -> Lexicon:
    """Learn from all rows of ``labelled`` (text, toxic 0/1; other labels are left out).

    Without a row of either class the lexicon is empty and every score is the share of
    toxic rows (0 if there is no row). ``exceptions`` are added to the learnt ones.
    """
    small_batches(labelled.sparkSession)
    rows = labelled.select("text", F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)")
    have = dict(rows.groupBy("toxic").count().collect())
    clean, toxic = have.get(0, 0), have.get(1, 0)
    if not clean or not toxic:
        return Lexicon({}, exceptions, (30.0 if toxic else -30.0, 0.0, 0.0))
    base = toxic / (clean + toxic)

    def counted(terms_of: Callable[[], Callable[[str], set[str]]], name: str) -> DataFrame:
        counts = rows.mapInArrow(lambda batches: _counts(batches, terms_of()), "word string, clean long, toxic long")
        return written(counts.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), name)

    entries = written(_entries(counted(lambda: words_of, "words"), base), "entries")
    lexicon = _blocks(entries, exceptions, block_bytes)
    for block in lexicon.blocks():
        if block.terms:

            def phrases(block: Lexicon = Lexicon(block.terms, ())) -> Callable[[str], set[str]]:
                words, _ = block.matcher()
                return lambda text: _phrases(text, words)

            safe = counted(phrases, "phrases").where(_bound(F.col("toxic"), F.col("clean"), base, 1) < MIN_LOG_ODDS)
            entries = entries.unionByName(safe.select(F.col("word").alias("pattern"), F.lit(None).cast("double").alias("weight")))
    lexicon = _blocks(written(entries.dropDuplicates(["pattern"]), "entries"), exceptions, block_bytes)

    def binned(batch: pa.RecordBatch, sums: list[tuple[float, float]]) -> pa.RecordBatch:
        seen = Counter((round(a * 4), round(b * 4), y) for (a, b), y in zip(sums, batch.column(1).to_pylist(), strict=True))
        keys = list(seen)
        return pa.record_batch([*(pa.array([k[i] for k in keys], pa.int32()) for i in range(3)), pa.array([seen[k] for k in keys], pa.int64())], ["a", "b", "y", "n"])

    cells = _with_features(rows, lexicon, "text", binned, "a int, b int, y int, n long").groupBy("a", "b", "y").agg(F.sum("n").alias("n")).orderBy("a", "b", "y").toPandas()
    fit = _logistic(cells[["a", "b"]].to_numpy(float) / 4, cells["y"].to_numpy(float), cells["n"].to_numpy(float))
    return replace(lexicon, fit=fit)


def score_texts(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and, last, a score from 0 to 1 named by ``free_name(docs, 'score')``.

    A null text counts as empty. No shuffle.
    """
    small_batches(docs.sparkSession)
    name = free_name(docs, "score")

    def scored(batch: pa.RecordBatch, sums: list[tuple[float, float]]) -> pa.RecordBatch:
        x = np.array(sums, float).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(lexicon.score(x), pa.float64())], names=[*batch.schema.names, name])

    return _with_features(docs, lexicon, text, scored, docs.withColumn(name, F.lit(0.0)).schema)


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Text and label of the documents whose crc32(doc_id as text) mod 5 is not 0.

    A label is one (doc_id, toxic) pair; repeated pairs count once, a document with both
    labels teaches nothing.
    """
    known = labels.where(remainder(F.col("doc_id"), 5) != 0).where("toxic in (0, 1)")
    known = known.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_most")).where("toxic = _most").drop("_most")
    known = written(known, "labels")
    # labels that fit a broadcast leave the texts where they are in each pass, whatever the planner's own limit; others move them once
    few = known.count() * LABEL_BYTES <= BROADCAST_BYTES
    joined = docs.select("doc_id", "text").join(F.broadcast(known) if few else known, "doc_id").select("text", "toxic")
    return joined if few else written(joined, "labelled")


def toxicity_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of each document; every row is returned.

    Held out is crc32(doc_id as text) mod 5 = 0; a null doc_id is not held out and, having
    no label, teaches nothing. Empty and null texts get the score of a text without hits.
    """
    lexicon = learn_lexicon(training_rows(docs, labels))
    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    out = score_texts(docs.select("doc_id", held_out.alias("held_out"), "text"), lexicon)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame, cut: float = 0.5) -> DataFrame:
    """The documents that score below ``cut``, with their own columns."""
    lexicon = learn_lexicon(training_rows(docs, labels))
    scored = score_texts(docs, lexicon)
    return scored.where(F.col(scored.columns[-1]) < cut).drop(scored.columns[-1])
