"""Chunking against a plain sequential splitter, and its properties."""

import random

import pytest
from pyspark.sql import functions as F

from inkwell.operators import chunks as C

BLANK = "".join(chr(i) for i in range(0x21))


def brute(text, p):
    """The rules, one window at a time."""
    chunks, counted = [], 0
    while text and (p.max_chunks is None or counted < p.max_chunks):
        window = text[: p.budget]
        if not window.strip(BLANK):
            text = text[len(window):]
            continue
        last = max(window.rfind(t) for t in C.TERMINATORS)
        if last > p.min_chars:
            window = window[: last + 1]
        chunks.append((window.strip(BLANK), False))
        counted += 1
        text = text[len(window):]
    if text.strip(BLANK):
        chunks.append((text.replace("\n", " ").strip(BLANK), True))
    return [c for c in chunks if len(c[0]) > p.min_len]


def texts():
    rnd = random.Random(7)
    alphabet = "aé\U0001f600b   .?!\n\t"
    out = ["", " ", "a", ".", "\n" * 50, "x" * 20, "x" * 21, "no stop here " * 30, "a. " * 100, " " * 45 + "tail"]
    out += ["".join(rnd.choices(alphabet, k=rnd.randint(1, 400))) for _ in range(150)]
    return out + [None]


@pytest.mark.parametrize(
    "p", [C.ChunkParams(20, 4), C.ChunkParams(20, 4, 0, 1000), C.ChunkParams(20, 4, 3, 3), C.ChunkParams(7, 6, 1, 5), C.ChunkParams(50, 10, 2, 1)]
)
def test_matches_sequential_splitter(spark, p):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc int, text string")
    got = docs.select("doc", C.split_text(F.col("text"), p).alias("c")).collect()
    for row in got:
        want = brute(texts()[row.doc] or "", p)
        assert [(c.text, c.overflow) for c in row.c] == want, row.doc


def test_windows_are_lossless(spark):
    p = C.ChunkParams(20, 4, 0, 1000)
    docs = spark.createDataFrame([(t,) for t in texts() if t], "text string")
    joined = docs.select("text", F.array_join(C._windows(F.col("text"), p, C.TERMINATORS), "").alias("j"))
    assert joined.where("text <> j").count() == 0


def test_table_form_numbers_over_pages(spark):
    docs = spark.createDataFrame([(1, ["one. two.", None, " \n", "three"]), (2, [" "])], "doc int, pages array<string>")
    rows = C.chunk_text(docs, "pages", C.ChunkParams(6, 2, 1, 10), ["doc"]).orderBy("doc", "chunk_no").collect()
    assert [(r.doc, r.page_no, r.chunk_no, r.n_chunks, r.text) for r in rows] == [
        (1, 1, 1, 3, "one."), (1, 1, 2, 3, "two."), (1, 4, 3, 3, "three"),
    ]


def test_report_and_rejoin(spark):
    docs = spark.createDataFrame([(1, ["one. two. " * 6])], "doc int, pages array<string>")
    chunks = C.chunk_text(docs, "pages", C.ChunkParams(6, 2, 1, 100), ["doc"])
    report = C.chunk_report(chunks, "doc").collect()[0].report
    assert report.startswith("=== CHUNK 1 OF 12 ===\none.\n\n=== CHUNK 2 OF 12 ===\n")
    assert report.endswith("=== CHUNK 12 OF 12 ===\ntwo.\n\n")
    assert C.rejoin_chunks(chunks, "doc").collect()[0].text == "one.two." * 6


@pytest.mark.parametrize(
    "size,rule,want",
    [
        (0, "normal", (4000, 100)), (3999, "normal", (4000, 100)), (4000, "normal", (4000, 100)), (8000, "normal", (8000, 200)),
        (8001, "normal", (8000, 200)), (262144, "normal", (8000, 200)), (262144, "large", (4000, 100)), (0, "large", (2000, 50)),
    ],
)
def test_params(size, rule, want):
    assert tuple(C.params_for(size, rule)) == (*want, 0, None)


def test_rule_columns_agree_with_params(spark):
    df = spark.createDataFrame([(s, b) for s in (0, 3999, 4000, 6001, 262144) for b in (True, False)], "s int, big boolean")
    for r in df.select("s", "big", *[e.alias(n) for n, e in C.rule_columns(F.col("s"), F.col("big")).items()]).collect():
        p = C.params_for(r.s, "large" if r.big else "normal")
        assert (r.tokens * 4, r.min_chars) == (p.budget, p.min_chars)
        assert (r.min_len, r.max_chunks) == (max(10 if r.big else 20, r.tokens // 50), 500 if r.big else 1000)


def test_nothing_is_lost_and_budget_holds(spark):
    """Short texts, short pieces and texts of very many windows; one more byte changes nothing before it."""
    p = C.ChunkParams(20, 4)
    samples = [t for t in texts() if t] + ["tiny", "a. b", "word. " * 3000]
    docs = spark.createDataFrame(list(enumerate(samples)), "doc int, text string")
    for r in docs.select("doc", C.split_text(F.col("text"), p).alias("c")).collect():
        solid = lambda t: "".join(ch for ch in t if ch not in BLANK)
        assert solid("".join(c.text for c in r.c)) == solid(samples[r.doc])
        assert all(0 < len(c.text) <= p.budget and not c.overflow for c in r.c)


def test_left_out_is_counted(spark):
    p = C.ChunkParams(20, 4, 6, 3)
    docs = spark.createDataFrame([(t,) for t in texts()], "text string")
    for r in docs.select("text", C.left_out(F.col("text"), p).alias("n")).collect():
        assert r.n == sum(len(t) for t, _ in brute(r.text or "", p._replace(min_len=0)) if len(t) <= 6)


def test_text_is_split_once_and_never_shuffled(spark):
    docs = spark.createDataFrame([(1, ["a. b."])], "doc int, pages array<string>")
    plan = C.chunk_text(docs, "pages", C.ChunkParams(20, 4, 0, 10), ["doc"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and "Exchange" not in plan


def test_long_document(spark):
    text = ("word " * 40 + ". ") * 20000
    for p in (C.params_for(262144, "large"), C.params_for(262144, "large")._replace(max_chunks=500)):
        df = spark.createDataFrame([(text,)], "t string").select(F.explode(C.split_text(F.col("t"), p)).alias("c")).select("c.*")
        rows = df.collect()
        assert [(r.text, r.overflow) for r in rows] == brute(text, p)
        assert len(rows) == 501 if p.max_chunks else len(rows) > 1000 and max(len(r.text) for r in rows) <= p.budget


def test_chunks_from_bytes(spark):
    """Bytes to pages to chunks without an intermediate file."""
    from inkwell.operators import extract as X

    files = spark.createDataFrame([("a.txt", bytearray(b"one. two. three.")), ("b.bin", bytearray(b"\xff"))], "filename string, content binary")
    rows = C.chunk_text(X.extract_text(files, readers={}), "pages", C.ChunkParams(6, 2, 1, 10), ["filename"]).collect()
    assert [(r.filename, r.text) for r in rows] == [("a.txt", "one."), ("a.txt", "two."), ("a.txt", "three")]  # the option leaves out "."
