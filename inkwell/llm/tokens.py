"""Token counts by a count-only Viterbi search over a unigram vocabulary.

An Aho-Corasick automaton of the vocabulary lists, at each character, the pieces that end
there. Going left to right, every character boundary keeps the best score of a segmentation
that ends there and its number of tokens; no back-pointers, no pieces. Tie rules are those
of the unigram tokenizer: candidates for a boundary are tried by rising start, a later one
wins only with a strictly higher score, and a character that is no piece itself may stand
alone at ten below the lowest score of the vocabulary. Such a character becomes one byte
token per UTF-8 byte if the vocabulary has byte tokens, otherwise one unknown token per run.

Blanks are written U+2581, one stands before the text, and a segmentation never crosses
the start of a blank, so each blank-led word is searched by itself (scores add up in double
precision per word). Words recur, so counts are remembered up to a fixed number of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from inkwell.llm.common import small_batches

META = "▁"
CUT = "\0"
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN_PENALTY = 10.0
CACHED_WORDS = 1_000_000
CACHED_LENGTH = 48


@dataclass(frozen=True)
class Vocabulary:
    """Matchable pieces with scores, whether byte tokens exist, and the lowest score of all ids."""

    pieces: tuple[tuple[str, float], ...]
    bytes: bool
    lowest: float

    @classmethod
    def from_model(cls, path: str) -> Vocabulary:
        """Pieces and scores of a tokenizer model file; control, unknown and byte ids do not match text."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        return cls(tuple((model.id_to_piece(i), model.get_score(i)) for i in plain), any(map(model.is_byte, ids)), min(map(model.get_score, ids)))


class Counter(dict):
    """Token counts of segments, searched on first use; one per worker process.

    Segments are cut before blanks and, with byte tokens, around characters that no piece
    contains (no piece can cross either), so a text's count is the sum of its segments' counts.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        import ahocorasick

        super().__init__()
        self.bytes, self.unknown = vocabulary.bytes, vocabulary.lowest - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        self.alphabet: set[str] = {META}
        self.single: set[str] = set()
        for piece, score in vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), score))
            self.alphabet.update(piece)
            if len(piece) == 1:
                self.single.add(piece)
        if len(self.automaton):
            self.automaton.make_automaton()

    def __missing__(self, word: str) -> int:
        segment = word[1:] if self.bytes and word[:1] == CUT else META + word
        n = self.search(segment)[0]
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = n
        return n

    def search(self, segment: str) -> tuple[int, float]:
        """Token count and best score of one segment."""
        if not self.single.issuperset(segment):
            return self._search_unknown(segment)
        best, tokens = [0.0] + [-math.inf] * len(segment), [0] * (len(segment) + 1)
        if segment:
            for end, (length, score) in self.automaton.iter(segment):  # at one end: longest, thus smallest start, first
                start = end + 1 - length
                s = best[start] + score
                if s > best[end + 1]:
                    best[end + 1] = s
                    tokens[end + 1] = tokens[start] + 1
        return tokens[-1], best[-1]

    def _search_unknown(self, segment: str) -> tuple[int, float]:
        """The same where a character of some pieces is no piece itself and may stand alone."""
        ending: list[list[tuple[int, float]]] = [[] for _ in segment]
        if len(self.automaton):
            for end, piece in self.automaton.iter(segment):
                ending[end].append(piece)
        best, tokens, alone = [0.0], [0], [False]
        for end, c in enumerate(segment):
            top, n, is_alone = -math.inf, 0, False
            for length, score in ending[end]:
                s = best[end + 1 - length] + score
                if s > top:
                    top, n = s, tokens[end + 1 - length] + 1
            if c not in self.single and best[end] + self.unknown > top:
                top, is_alone = best[end] + self.unknown, True
                n = tokens[end] + (len(c.encode("utf-8", "surrogatepass")) if self.bytes else int(not alone[end]))
            best.append(top)
            tokens.append(n)
            alone.append(is_alone)
        return tokens[-1], best[-1]

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = text.replace(" ", META) if META in text else text
        total, strange = 0, set(text) - self.alphabet - {" "}
        if strange and self.bytes:  # without byte tokens their runs have to stay with their neighbours
            total = sum(text.count(c) * len(c.encode("utf-8", "surrogatepass")) for c in strange)
            for c in strange - {CUT}:
                text = text.replace(c, CUT)
            text = text.replace(CUT, f" {CUT}")
        words = text.replace(META, " ").split(" ")
        if words[0] == "" and len(words) > 1 and text[0] in (" ", META) and not (self.bytes and words[1][:1] == CUT):
            words = words[1:]  # the text's own blank stands in for the one before it
        return total + sum(map(self.__getitem__, words))


@cache
def _counter(vocabulary: Vocabulary) -> Counter:
    return Counter(vocabulary)


def count_tokens(docs: DataFrame, keep: list[str], vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``keep`` columns of every row with n_tokens (0 for null and empty texts). No shuffle."""
    small_batches(docs.sparkSession)
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("n_tokens", T.LongType())])
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared.value)
        for batch in batches:
            found = [counter.count(t or "") for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.int64())], names=[*keep, "n_tokens"])

    return docs.select(*keep, text).mapInArrow(counted, schema)


def tokens_query(docs: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """doc_id, n_tokens of each row; repeated and null ids are rows like any other."""
    return count_tokens(docs, ["doc_id"], Vocabulary.from_model(model))
