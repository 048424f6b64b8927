"""Chunks from byte ranges equal the chunks of whole texts."""

import io
import random

import pytest

from inkwell.operators import chunks as C, splits as S
from inkwell.plans.process import chunk_large_references, chunk_references, staged
from inkwell.sources.fetch import fetch_content
from tests.test_chunks import brute

SMALL = C.ChunkParams(budget=40, min_chars=7)


def text(seed, n):
    r = random.Random(seed)
    pieces = ["a", "é", "日", "\U0001f600", "b c ", ". ", "?", "\n", "   ", " " * 90, "x" * 70]
    return "".join(r.choices(pieces, weights=[20, 5, 5, 5, 20, 4, 1, 2, 4, 1, 1], k=n))


def cases():
    out = {f"t{i}.txt": text(i, 150).encode() for i in range(6)}
    out |= {"big.txt": text(99, 9000).encode(), "empty.txt": b"", "blank.txt": b" \n" * 300, "solid.txt": b"x" * 3000, "one.txt": "é".encode()}
    out |= {"mark.txt": b"\xef\xbb\xbf" + text(7, 100).encode(), "le.txt": b"\xff\xfe" + text(8, 100).encode("utf-16-le"), "be.txt": b"\xfe\xff" + text(9, 100).encode("utf-16-be")}
    out |= {"latin.txt": b"caf\xe9 \x80. " * 60, "stray.txt": b"abc. " * 50 + b"\x80\x80\x80\x80\x80" + b"def " * 40, "cut.txt": b"word. " * 43 + b"\xe6\x97"}
    return out


def whole(data):
    for mark, name in S.MARKS.items():
        if data.startswith(mark):
            return data[len(mark) :].decode(name)
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        return "".join(S.ONE_BYTE["windows-1252"][b] for b in data)


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("splits")
    for name, data in cases().items():
        (folder / name).write_bytes(data)
    rows = [(str(folder / name), len(data)) for name, data in cases().items()]
    return spark.createDataFrame([*rows, rows[0], (None, 5)], "path string, length long")


@pytest.mark.parametrize("split", [64, 1 << 20])
def test_ranges_of_any_size_give_the_chunks_of_the_whole(files, split):
    found = {}
    for r in S.chunk_files(files, SMALL, staged, split).collect():
        found.setdefault(r.path.rsplit("/", 1)[1], []).append((r.chunk_no, r.n_chunks, r.text))
    for name, data in cases().items():
        want = [c for c, _ in brute(whole(data), SMALL)]
        assert sorted(found.get(name, [])) == [(i, len(want), c) for i, c in enumerate(want, 1)], name


def test_files_without_a_known_encoding_give_nothing(files):
    found = {r.path.rsplit("/", 1)[1] for r in S.chunk_files(files, SMALL, staged, 64, fallback=None).collect()}
    assert not found & {"latin.txt", "stray.txt", "cut.txt"} and {"big.txt", "le.txt", "t0.txt"} <= found


def test_options_of_whole_texts_are_refused(files):
    with pytest.raises(ValueError):
        S.chunk_files(files, SMALL._replace(min_len=3), staged)
    with pytest.raises(ValueError):
        S.chunk_files(files, SMALL, staged, 6)


def test_ranges_of_bytes_hold_the_characters_of_the_whole():
    for name, data in cases().items():
        want = whole(data)
        for split in (4, 12, 1000):
            for encoding in (None, "windows-1252"):
                parts = [S._part(io.BytesIO(data), len(data), low, min(len(data), low + split), 9, encoding) for low in range(0, len(data), split)]
                if encoding is None and None not in parts:
                    assert "".join(x.text[: x.own] for x in parts) == want, name
                elif name in ("latin.txt", "stray.txt", "cut.txt"):
                    assert encoding is None or "".join(x.text[: x.own] for x in parts) == want, name


def test_empty_listing(files):
    assert S.chunk_files(files.where("length = 0"), SMALL, staged).collect() == []


def test_tables_compose_to_the_whole():
    """Fold of a text cut anywhere: the exit of one part is the entry of the next. Here ranges of a few characters."""
    r = random.Random(3)
    for i in range(40):
        t = text(i, 60)
        p = C.ChunkParams(budget=r.choice([5, 20, 64]), min_chars=r.choice([0, 3, 19, 80]))
        cuts = sorted({0, len(t), *(r.randrange(len(t)) for _ in range(3))})
        entry = count = 0
        for low, high in zip(cuts, cuts[1:], strict=False):
            out, n = S._fold(S.Part(t[low : high + p.budget], high - low), p, C.TERMINATORS, p.budget)
            entry, count = int(out[entry]), count + int(n[entry])
        assert (entry, count) == (0, len(brute(t, p)))


def test_large_references_give_the_chunks_of_small_ones(spark, tmp_path):
    names = {"a.txt": text(1, 400), "b.txt": text(2, 20), "c.md": text(3, 300), "d.pdf": text(4, 300), "e f.txt": text(5, 300)}
    for name, t in names.items():
        (tmp_path / name).write_text(t, encoding="utf-8")
    rows = [(i, "FIRST", f"http://n:9870/webhdfs/v1{tmp_path}/{n}".replace(" ", "%20"), n) for i, n in enumerate([*names, "gone.txt", "a.txt"])]
    refs = spark.createDataFrame(rows, "msg_id int, dedupe string, url string, filename string")
    limited = lambda r: fetch_content(r, max_bytes=200)
    small = chunk_references(refs, limited, SMALL, ["msg_id"], readers={})
    large = chunk_large_references(limited(refs), SMALL, ["msg_id"], split_bytes=64)
    assert large.columns == small.columns
    found = sorted(map(tuple, small.unionByName(large).collect()))
    want = sorted(map(tuple, chunk_references(refs, fetch_content, SMALL, ["msg_id"], readers={}).collect()))
    assert {r[0] for r in want} == {0, 1, 2, 4, 6} and found == want


def test_following_a_range_gives_what_its_table_gives():
    r = random.Random(4)
    for i in range(40):
        t = text(i, 80)
        p = C.ChunkParams(budget=r.choice([5, 20, 64]), min_chars=r.choice([0, 3, 19, 80]))
        part = S.Part(t, r.randrange(len(t)) if i % 5 else len(t))
        out, n = S._fold(part, p, C.TERMINATORS, p.budget)
        for at in range(min(p.budget, part.own)):
            end, chunks = S._walk(part, at, p, C.TERMINATORS)
            assert (end, len(chunks)) == (int(out[at]), int(n[at]))


def test_no_table_is_composed_for_files_of_few_ranges(files, monkeypatch):
    """Up to FAN ranges the tables of a file are followed once, not composed and handed down."""
    monkeypatch.setattr(S, "_up", None)
    assert S.chunk_files(files, SMALL, staged, 256).count() > 0
