"""Chunks by token budget against the tokenizer's own counts."""

import base64
import random
import time

import public_tokenizers
import pytest
import tiktoken

from inkwell.operators import tokens as TK

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def reference(vocabulary):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def some_texts():
    r = random.Random(3)
    parts = ["word", " Another", "'s", "'ll", "!!!'", "s", " ", "   ", "\n", "\n\n", "\t", ". ", "? ", "1234567", " 99", "é", " Straße", "漢字かな", "😀", " ", "x" * 70, "=-" * 30, " " * 60, "ab" * 40, "\x85"]
    return ["", " ", "\n \n", "a", "a" * 500, "😀" * 90, "'" * 300 + "s", " " * 400 + "b"] + ["".join(r.choices(parts, k=r.randint(1, 120))) for _ in range(150)]


def windows_by_loop(text, budget, min_chars, enc):
    """The rules of the module read off the tokenizer: the pieces are those that end where its own ones do."""
    import regex

    out, pieces = [], []
    for p in regex.findall(public_tokenizers.PATTERN, text):
        if len(enc.encode_ordinary(p)) <= budget:
            pieces.append((p, False))
            continue
        part = ""
        for c in p:
            if len((part + c).encode()) > budget:
                pieces.append((part, True))
                part = ""
            part += c
        pieces.append((part, True))
    at = 0
    while at < len(pieces):
        stop, total = at, 0
        while stop < len(pieces) and (stop == at or total + len(enc.encode_ordinary(pieces[stop][0])) <= budget):
            total += len(enc.encode_ordinary(pieces[stop][0]))
            stop += 1
            if pieces[stop - 1][1]:
                break
        follows = stop < len(pieces) and not pieces[stop - 1][1]
        ends = [e for e in range(at + 1, stop + 1) if len(enc.encode_ordinary("".join(p for p, _ in pieces[at:e]))) <= budget]
        good = [e for e in ends if pieces[e - 1][0][-1] in TK.TERMINATORS and sum(len(p) for p, _ in pieces[at:e]) > min_chars]
        stop = good[-1] if good and follows else ends[-1]
        out.append("".join(p for p, _ in pieces[at:stop]))
        at = stop
    return out


def test_ids_equal_those_of_the_tokenizer(vocabulary, reference):
    own = TK.BytePairs(vocabulary)
    assert TK.PATTERN == public_tokenizers.PATTERN
    for text in some_texts():
        assert [i for m in own.pieces.finditer(text) for i in own.encode(m[0])] == reference.encode_ordinary(text)


@pytest.mark.parametrize(("budget", "min_chars"), [(4, 0), (7, 3), (16, 10), (64, 0), (64, 100), (4000, 0)])
def test_windows_match_a_loop_and_the_tokenizers_counts(vocabulary, reference, budget, min_chars):
    own = TK.BytePairs(vocabulary)
    for text in some_texts():
        found = list(own.windows(text, budget, min_chars))
        assert "".join(w for w, _ in found) == text
        assert [n for _, n in found] == [len(reference.encode_ordinary(w)) for w, _ in found]
        assert all(0 < n <= budget for _, n in found)
        assert [w for w, _ in found] == windows_by_loop(text, budget, min_chars, reference)


def test_long_runs_take_no_square_time(vocabulary):
    own = TK.BytePairs(vocabulary)

    def seconds(n):
        r = random.Random(1)
        start = time.perf_counter()
        assert sum(k for _, k in own.windows("".join(r.choices("abcdefgh", k=n)), 512, 0)) > 0
        return time.perf_counter() - start

    assert seconds(200_000) < 0.5 + 10 * seconds(50_000)


def test_chunks_of_a_table(spark, vocabulary, reference, monkeypatch):
    assert TK.read_vocabulary(spark, PATH) == vocabulary
    rows = [(i, t) for i, t in enumerate(some_texts())] + [(None, "one. two. three."), (1000, None), (1000, None), (1001, "Same. " * 40), (1001, "Same. " * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, body string").selectExpr("*", "'x' as chunk", "1 as n_tokens", "2 as _text")
    for most in (TK.BATCH_BYTES, 50):
        monkeypatch.setattr(TK, "BATCH_BYTES", most)
        found = TK.chunk_by_tokens(docs, "body", ["doc_id"], vocabulary, 32, 20).collect()
        want = []
        for i, t in rows:
            filled = [w for w in windows_by_loop(t or "", 32, 20, reference) if w.strip("".join(map(chr, range(33))))]
            want += [(i, n, len(filled), w, len(reference.encode_ordinary(w))) for n, w in enumerate(filled, 1)]
        assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    assert TK.chunk_by_tokens(docs.limit(0), "body", ["doc_id"], vocabulary, 32).collect() == []
    with pytest.raises(ValueError):
        TK.chunk_by_tokens(docs, "body", [], vocabulary, 3)


def test_frequent_pieces_stay_known_among_many_new_ones(vocabulary, monkeypatch):
    monkeypatch.setattr(TK, "CACHED_PIECES", 20)
    own = TK.BytePairs(vocabulary)
    made = []
    encode = own.encode
    own.known.encode = lambda piece: made.append(piece) or encode(piece)
    for i in range(500):
        list(own.windows(f"frequentword novel{i}x", 50, 0))
    assert made.count("frequentword") == 1
    assert len(own.known) <= 20 and len(own.known.earlier) <= 20


def test_a_batch_of_chunks_is_small(vocabulary, spark):
    """What a worker holds of its results and of its input."""
    assert TK.BATCH_BYTES <= 4 << 20
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 16 << 20
