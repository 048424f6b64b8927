"""Extraction by content type, container formats, directory batch."""

import io
import zipfile

from pyspark.sql import functions as F

from inkwell.operators import extract as X
from inkwell.plans.process import process_directory
from inkwell.sources.files import attach_content, scan_files

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def archive(members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)
    return buf.getvalue()


DOCX = archive({
    "word/document.xml": f'<w:document xmlns:w="{W}"><w:body><w:p><w:r><w:t>Hello</w:t></w:r><w:r><w:tab/><w:t>wörld</w:t></w:r></w:p>'
    "<w:p><w:r><w:t>Second</w:t></w:r></w:p></w:body></w:document>",
})
ODT = archive({"content.xml": '<o xmlns:t="urn:t"><t:h>Title</t:h><t:p>Body<t:s/>text</t:p></o>'})
PPTX = archive({f"ppt/slides/slide{i}.xml": f'<s xmlns:a="urn:a"><a:p><a:t>slide {i}</a:t></a:p></s>' for i in (10, 2, 1)})


DEEP = archive({"content.xml": "<d>" * 3000 + "<p>down &amp;lt; here</p>" + "</d>" * 3000})


def files(spark, items):
    return spark.createDataFrame([(n, bytearray(c)) for n, c in items], "filename string, content binary")


def test_formats(spark):
    items = [
        ("a.txt", "plain é".encode()), ("b.html", b"<html><body><p>x</p>y</body></html>"), ("c.docx", DOCX), ("d.odt", ODT),
        ("e.pptx", PPTX), ("k.odt", DEEP), ("f.docx", b"not a zip"), ("g.txt", b"caf\xe9 \x80"), ("h.bin", b"\x00\xff"), ("i", b"no extension"), ("j.csv", b"a,b"),
    ]
    got = {r.filename: r for r in X.extract_text(files(spark, items)).collect()}
    assert got["a.txt"].text == "\n\nplain é"
    assert got["b.html"].text == "\n\nx\ny"
    assert got["c.docx"].text == "\n\nHello wörld\nSecond"
    assert got["d.odt"].text == "\n\nTitle\nBody text"
    assert got["k.odt"].text == "\n\ndown &lt; here"
    assert got["e.pptx"].pages == ["slide 1", "slide 2", "slide 10"]
    assert (got["f.docx"].failure, got["f.docx"].text) == ("PARSE_ERROR", "") and "BadZipFile" in got["f.docx"].error_message
    assert got["g.txt"].text == "\n\ncafé €"
    strict = {r.filename: r for r in X.extract_text(files(spark, items), readers={}, fallback=None).collect()}
    assert strict["g.txt"].failure == "UNDECODABLE" and strict["a.txt"].failure is None
    assert got["h.bin"].failure == "UNSUPPORTED_FORMAT"
    assert got["i"].text == "\n\nno extension" and got["j.csv"].text == "\n\na,b"
    assert all(got[n].failure is None for n in ("a.txt", "b.html", "c.docx", "d.odt", "i", "j.csv"))


def test_encodings(spark):
    page = '<html><head><meta charset="{}"></head><p>é € ü</p>'
    items = [
        ("a.txt", b"\xef\xbb\xbf" + "é".encode()), ("b.txt", "é🙂".encode("utf-16")), ("c.txt", b"\xfe\xff" + "é🙂".encode("utf-16-be")),
        ("d.html", page.format("windows-1252").encode("cp1252")), ("e.html", page.format("utf-8").encode()),
        ("f.html", page.format("ISO-8859-1").encode("cp1252")), ("g.txt", b"\xff\xfea"), ("h.txt", b""),
        ("i", b" " * 70 + b"<html><p>x</p></html>"), ("j", b"\n<?xml version='1.0'?>\n<!-- c --><!DOCTYPE html><p>x"), ("k", b"<htmlish>"),
        ("l.html", b"<p>&eacute;&euro;&#0000000233;&#x000E9;&nosuch;&notin;&amp;lt;</p>"),
    ]
    got = {r.filename: r for r in X.extract_text(files(spark, items), readers={}).collect()}
    texts = {n: (r.text or "").strip() for n, r in got.items()}
    assert [texts[x] for x in ("a.txt", "b.txt", "c.txt")] == ["é", "é🙂", "é🙂"]
    assert [texts[x] for x in ("d.html", "e.html", "f.html")] == ["é € ü"] * 3
    assert texts["g.txt"] == "\ufffd" and texts["h.txt"] == ""
    assert [got[x].mime for x in "ijk"] == ["text/html", "text/html", "text/plain"] and texts["i"] == texts["j"] == "x"
    assert texts["l.html"] == "é€éé&nosuch;∉&lt;"


def test_pluggable_readers(spark):
    got = X.extract_text(
        files(spark, [("a.rtf", b"{\\rtf1 x}"), ("b.md", b"# T")]),
        readers={"application/rtf": lambda data: [data.decode().upper()]},
        native={"text/x-none": F.upper},
    ).orderBy("filename").collect()
    assert got[0].text == "\n\n{\\RTF1 X}" and got[1].text == "\n\n# T"


def test_no_python_in_the_plan_without_readers(spark):
    plan = X.extract_text(files(spark, []), readers={})._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_directory_scan_and_batch(spark, tmp_path):
    src = tmp_path / "in"
    (src / "sub").mkdir(parents=True)
    for name, data in {"a.txt": b"text", "blank.txt": " \u2003".encode(), "x.pdf": b"%PDF-", "done.txt": b"old", "d.docx": DOCX}.items():
        (src / name).write_bytes(data)
    (src / "sub" / "deep.txt").write_bytes(b"deep")
    scan = scan_files(spark, str(src))
    assert scan.count() == 5 and scan_files(spark, str(src), recursive=True).count() == 6
    assert scan_files(spark, str(src), metadata_only=True).columns == ["path", "modificationTime", "length"]
    done = scan.where("path like '%done.txt'").select("path")
    got = {r.filename: r for r in process_directory(scan, done).collect()}
    assert {n: (r.outcome, r.destination) for n, r in got.items()} == {
        "a.txt": ("COMPLETED", "processed"), "blank.txt": ("BLANK", "error"), "x.pdf": ("UNSUPPORTED_FORMAT", "error"),
        "d.docx": ("COMPLETED", "processed"),
    }
    assert got["a.txt"].text == "\n\ntext"


def test_attach_content_matches_paths(spark, tmp_path):
    (tmp_path / "a b.txt").write_bytes(b"x")
    files_df = scan_files(spark, str(tmp_path))
    refs = spark.createDataFrame(
        [(1, f"http://nn/webhdfs/v1{tmp_path}/a%20b.txt?op=OPEN"), (2, f"http://nn/webhdfs/v1{tmp_path}/none.txt")], "msg_id long, url string"
    )
    got = {r.msg_id: (r.fetched, r.content) for r in attach_content(refs, files_df).collect()}
    assert got == {1: (True, bytearray(b"x")), 2: (False, None)}


def test_fetch_content_opens_only_named_files(spark, tmp_path):
    from inkwell.sources.fetch import fetch_content

    (tmp_path / "a.txt").write_bytes(b"abc")
    (tmp_path / "dir").mkdir()
    refs = spark.createDataFrame(
        [(i, f"http://nn/webhdfs/v1{tmp_path}/{n}") for i, n in enumerate(["a.txt", "b.txt", "dir", "bad%zz"])], "msg_id long, url string"
    )
    got = {r.msg_id: r for r in fetch_content(refs).collect()}
    assert (got[0].fetched, bytes(got[0].content), got[0].length) == (True, b"abc", 3)
    assert [got[i].fetched for i in (1, 2, 3)] == [False] * 3 and got[1].fetch_error == "NOT_FOUND"
    limited = {r.msg_id: r for r in fetch_content(refs, max_bytes=2).collect()}
    assert limited[0].fetch_error == "TOO_LARGE"


def test_many_small_files_are_few_tasks(spark, tmp_path):
    """The part of the scan for large files has no task, and a task reads many small files."""
    for i in range(300):
        (tmp_path / f"{i}.txt").write_text(f"text {i}")
    scan = scan_files(spark, str(tmp_path))
    assert scan.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    assert sorted(bytes(r.content) for r in scan.collect()) == sorted(f"text {i}".encode() for i in range(300))


def tree(root, names):
    for name, data in names.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(data)
    return {f"file:{root / name}": data for name, data in names.items()}


def test_the_driver_holds_no_file_names(spark, tmp_path):
    tree(tmp_path, {f"{i % 7}/{i}.txt": b"x" * i for i in range(300)})
    scan = scan_files(spark, str(tmp_path), recursive=True)
    assert not [f for f in scan.inputFiles() if f.endswith(".txt")]
    assert sorted((r.length, len(r.content)) for r in scan.collect()) == [(i, i) for i in range(300)]


def test_scan_keeps_empty_files_and_what_the_reader_finds(spark, tmp_path, monkeypatch):
    """Folders in several rounds, contents in several batches; a missing folder is an error as before."""
    from pyspark.errors import AnalysisException

    from inkwell.sources import files as FS, listing as LS

    monkeypatch.setattr(LS, "STEP", 3)
    monkeypatch.setattr(LS, "ROWS", 2)
    monkeypatch.setattr(FS, "BATCH_BYTES", 5)
    deep = "/".join("abcdefgh")
    names = ["a.txt", "b b+%20é.txt", "c#?.md", "_k=v.txt", "sub/k=1/d.txt", "sub/e.log", f"{deep}/f.txt", *(f"many/{i}/{i}.txt" for i in range(20))]
    wanted = tree(tmp_path, {n: n.encode() for n in names} | {"sub/empty.txt": b""})
    tree(tmp_path, {n: b"hidden" for n in (".h.txt", "_h.txt", "x._COPYING_", ".h/x.txt", "_h/x.txt")})
    (tmp_path / "gone.txt").symlink_to(tmp_path / "none")

    def rows(df):
        return {r.path: (r.modificationTime, r.length, bytes(r.content)) for r in df.collect()}

    for kw in ({}, {"glob": "*.txt"}, {"glob": "{a,b}*.t[x]t"}, {"glob": "[!a]*"}):
        got = rows(scan_files(spark, str(tmp_path), recursive=True, **kw))
        assert all(v[1:] == (len(wanted[p]), wanted[p]) for p, v in got.items())
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", kw.get("glob", "*"))
        assert {p: v for p, v in got.items() if v[1]} == rows(reader.load(str(tmp_path)))
    assert set(rows(scan_files(spark, str(tmp_path), recursive=True))) == set(wanted)
    assert set(rows(scan_files(spark, str(tmp_path)))) == {p for p in wanted if p.count("/") == f"file:{tmp_path}/".count("/")}
    assert set(rows(scan_files(spark, f"{tmp_path}/s*/"))) == {p for p in wanted if "/sub/e" in p}
    assert scan_files(spark, str(tmp_path / "a.txt")).count() == 1
    monkeypatch.setattr(FS, "MAX_FILE_BYTES", 4)
    large = {r.path.rsplit("/", 1)[-1]: r.content for r in scan_files(spark, str(tmp_path), recursive=True, glob="[a1]*").collect()}
    assert large["a.txt"] is None and bytes(large["1.txt"] or b"-") == b"-" and len(large) == 12
    try:
        scan_files(spark, str(tmp_path / "none"))
        raise AssertionError("a missing folder was scanned")
    except AnalysisException as e:
        assert "PATH_NOT_FOUND" in str(e)


def test_documents_without_text_are_empty_files(spark, tmp_path):
    import duckdb

    from inkwell.plans import catalog, oracle

    texts = [(1, "a", "news"), (2, "", "news"), (3, None, "web")]
    spark.createDataFrame(texts, "doc_id long, text string, source string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(oracle.ORACLES["scan_binary"]).fetchall()
    assert sorted(map(tuple, catalog.QUERIES["scan_binary"](spark, str(tmp_path)).collect())) == sorted(want) and len(want) == 3


def test_content_is_read_for_the_rows_that_need_it(spark, tmp_path):
    tree(tmp_path, {f"{i}.txt": b"text" for i in range(5)})
    scan = scan_files(spark, str(tmp_path))
    (tmp_path / "3.txt").unlink()
    assert scan.select("path", "length").count() == len(scan.select("path").collect()) == 5
    assert {bytes(r.content) for r in scan.where("path not like '%3.txt'").collect()} == {b"text"}
    done = scan.where("path like '%3.txt'").select("path")
    plan = process_directory(scan, done)
    assert plan._jdf.queryExecution().executedPlan().toString().count("read(path") == 1 and plan.count() == 4


def test_scan_of_a_store_that_only_spark_opens(spark, tmp_path):
    tree(tmp_path, {"sub/a.txt": b"a"})
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.scan.link./in", f"file://{tmp_path}")
    scan = scan_files(spark, "viewfs://scan/in", recursive=True)
    assert [(r.path, bytes(r.content)) for r in scan.collect()] == [("viewfs://scan/in/sub/a.txt", b"a")]
