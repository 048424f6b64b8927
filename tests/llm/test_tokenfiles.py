"""Token files against the tokenizers library, document by document."""

import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from inkwell.llm import tokenfiles as TF
from inkwell.llm.common import work_path

LIBRARY = Tokenizer.from_file(TF.default_tokenizer())


def by_library(rows):
    """(doc_id, start, n_tokens, crc32) in rising id order; equal rows follow each other in any order."""
    out, start = [], 0
    for key, text in rows:
        ids = np.array(LIBRARY.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def texts(r):
    alphabet = ["a", "b", "don't", "'ll", " ", "  ", "\n", "\n\n", "\t ", "\u00a0", "\u2003", "\u3000", "\x1c", "\x85", "é", "日本", "12", "३", "!?", "😀", "\u0301", "<|endoftext|>", "word", " word"]
    made = ["".join(r.choices(alphabet, k=r.randint(0, 40))) for _ in range(150)]
    return [*made, "", " ", "\n", "x" * 5000, "  lead", "trail  ", "a  <|endoftext|> b", "\x00", "word " * 30_000, "\r\n\r\n x"]


def test_runs_give_the_ids_of_the_whole_text():
    r = random.Random(5)
    encoder = TF.Encoder(TF.default_tokenizer())
    assert encoder.by_runs and encoder.kind.itemsize == 2
    many = [t for _ in range(5) for t in texts(r)]
    got = [np.frombuffer(b, encoder.kind).tolist() for b in encoder.encode(many)]
    assert got == [LIBRARY.encode(t, add_special_tokens=False).ids for t in many]


def test_files_match_the_library(spark):
    r = random.Random(6)
    rows = list(enumerate(texts(r)))
    r.shuffle(rows)
    docs = spark.createDataFrame([(i * 3 - 50, t, 1, "s") for i, t in rows], "doc_id long, text string, start int, ids string").repartition(3)
    want = by_library([(i * 3 - 50, t) for i, t in sorted(rows)])
    for parts in (None, 1, 7):
        assert sorted(map(tuple, TF.tokenfiles_query(docs, parts=parts).collect())) == want


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(None, None), (None, "a b"), (4, None), (4, "same text")] + [(4, "same text")] * 400 + [(-9, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, TF.tokenfiles_query(docs, parts=5).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, -9] + [4] * 402
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1].tolist()]
    count = lambda t: len(LIBRARY.encode(t, add_special_tokens=False).ids) + 1
    assert sorted(r[2] for r in got) == sorted(count(t or "") for _, t in rows)
    assert TF.tokenfiles_query(docs.limit(0)).collect() == []


def test_stream_and_bases(spark, monkeypatch):
    monkeypatch.setattr(TF, "BLOCK_SHARDS", 2)
    docs = spark.createDataFrame([(i, f"text number {i} " * (i % 5)) for i in range(60)], "doc_id long, text string").repartition(2)
    shards = TF.write_tokens(docs, work_path(spark, "test"), parts=7)
    stream, rows = TF.TokenStream(shards), sorted(map(tuple, TF.read_tokens(shards).collect()))
    flat = np.concatenate([np.frombuffer(r[3], "<u4") for r in rows])
    assert len(stream) == len(flat) and len(stream.shards) > 3
    assert [s.base_docs for s in stream.shards] == [0, *np.cumsum([s.n_docs for s in stream.shards])[:-1].tolist()]
    for start, n in ((0, 10), (17, 200), (len(flat) - 3, 50), (0, len(flat)), (len(flat), 5)):
        assert stream.window(start, n).tolist() == flat[start : start + n].tolist()
    # files of an attempt that was not committed are not part of the stream
    wide = TF.write_tokens(docs.limit(0), work_path(spark, "test"))
    assert len(TF.TokenStream(wide)) == 0 and TF.TokenStream(wide).window(0, 3).tolist() == []


def test_new_words_are_encoded_many_to_a_text():
    """And get the ids that each has by itself, behind known ones, signs, line ends and runs of blanks too."""
    words = [f"w{i}ord" for i in range(3000)] + ["ß1", "日本", "x" * 40, "a-b", "'s", "İ", "end.", "end.,", "..."]
    texts = [" ".join(words), "a\nb " + " ".join(reversed(words)), "", " ", "two  blanks " + words[5], "\n".join(words[:50]), "tab\tin w7ord"]
    own = TF.Encoder(TF.default_tokenizer())
    calls = []
    library = own._library
    own._library = lambda t: calls.append(len(t)) or library(t)
    found = own.encode(texts)
    assert sum(calls) < 600
    kind = own.kind
    want = [own.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [list(map(int, np.frombuffer(f, kind))) for f in found] == want
    assert own.encode(texts) == found
