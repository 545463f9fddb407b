import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from rankloom.sources import files, loaders, tables
from rankloom.streaming.ingest import ingest_available, stored_pages

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
S = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
P = 'xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
REL = 'xmlns="http://schemas.openxmlformats.org/package/2006/relationships"'


def archive(**parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name.replace("__", "/").replace("_DOT_", "."), text)
    return out.getvalue()


def docx(*paragraphs):
    body = "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs)
    return archive(word__document_DOT_xml=f"<w:document {W}><w:body>{body}</w:body></w:document>")


def xlsx():
    rows = '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1"><v>7</v></c></row><row r="2"/><row r="3"><c r="B3" t="inlineStr"><is><t>in</t></is></c></row>'
    return archive(
        xl__workbook_DOT_xml=f'<workbook {S}><sheets><sheet name="One" sheetId="1" r:id="rId1"/></sheets></workbook>',
        xl___rels__workbook_DOT_xml_DOT_rels=f'<Relationships {REL}><Relationship Id="rId1" Target="worksheets/s.xml"/></Relationships>',
        xl__worksheets__s_DOT_xml=f"<worksheet {S}><sheetData>{rows}</sheetData></worksheet>",
        xl__sharedStrings_DOT_xml=f"<sst {S}><si><t>head</t></si></sst>",
    )


def pptx():
    cell = lambda t: f"<a:tc><a:txBody><a:p><a:r><a:t>{t}</a:t></a:r></a:p></a:txBody></a:tc>"
    slide = f"<p:sld {P}><p:cSld><p:spTree><p:sp><p:txBody><a:p><a:r><a:t> Title </a:t></a:r></a:p><a:p/></p:txBody></p:sp><p:graphicFrame><a:tbl><a:tr>{cell('x')}{cell('y')}</a:tr></a:tbl></p:graphicFrame></p:spTree></p:cSld></p:sld>"
    return archive(
        ppt__presentation_DOT_xml=f'<p:presentation {P}><p:sldIdLst><p:sldId id="1" r:id="rId5"/></p:sldIdLst></p:presentation>',
        ppt___rels__presentation_DOT_xml_DOT_rels=f'<Relationships {REL}><Relationship Id="rId5" Target="slides/s1.xml"/></Relationships>',
        ppt__slides__s1_DOT_xml=slide,
    )


def test_office_formats():
    assert loaders.load_pages(docx("one", "two"), "a.DOCX") == [(1, "one\n\ntwo", {"page": "0", "chunk_method": "text_split_3k"})]
    assert loaders.load_pages(xlsx(), "a.xlsx")[0][1] == "[Sheet: One]\nhead |  | 7\n | in | "
    assert loaders.load_pages(pptx(), "a.pptx") == [(1, "Title\nx | y", {"page": "0", "slide_number": "1"})]
    assert loaders.load_pages(docx(" "), "a.docx")[0][2]["format_note"] == "empty_docx"


def test_text_formats():
    assert [t for _, t, _ in loaders.load_pages("é".encode("latin-1"), "a.txt")] == ["é"]
    assert loaders.load_pages(b"", "a.txt")[0][2]["format_note"] == "empty_txt"
    assert loaders.load_pages(b'{"a":[1]}', "a.json")[0][1] == json.dumps({"a": [1]}, indent=2)
    assert loaders.load_pages(b"{" * 7000, "a.json")[0][1] == "{" * 6000
    rows = "h1,h2\n" + "".join(f"{i},x\n" for i in range(60))
    got = loaders.load_pages(rows.encode(), "a.csv")
    assert [m["row_range"] for _, _, m in got] == ["1-50", "51-60"] and got[1][1].split("\n")[:3] == ["h1 | h2", "-------", "50 | x"]
    assert loaders.load_pages(b"h1,h2\n", "a.csv")[0][1] == "h1 | h2\n-------\nh1 | h2"
    assert loaders.load_pages(b"\x00\x01Some words\xff\xffab\x00more text", "a.doc")[0][1] == "Some words\nmore text"
    with pytest.raises(ValueError):
        loaders.load_pages(b"", "a.exe")


def test_folder_to_pages(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.txt").write_text("hello world")
    (tmp_path / "b.docx").write_bytes(b"not a zip")
    (tmp_path / "c.png").write_bytes(b"x")
    (tmp_path / "Thumbs.db").write_bytes(b"x")
    listed = files.listing(spark, str(tmp_path))
    assert {r["rel_path"]: r["taken"] for r in listed.collect()} == {"sub/a.txt": True, "b.docx": True, "c.png": False, "Thumbs.db": False}
    assert {r["extension"] for r in files.skipped_extensions(listed).collect()} == {".png", ".db"}
    pages, rejected = files.read_pages(spark, str(tmp_path))
    row = pages.collect()[0]
    assert (row["rel_path"], row["page_number"], row["content_chars"], row["summary"]) == ("sub/a.txt", 1, 11, "hello world")
    assert [r["rel_path"] for r in rejected.collect()] == ["b.docx"]
    own, none = files.read_pages(spark, str(tmp_path), ("docx",), {".docx": lambda data, name: [("mine", {})]})
    assert [r["doc_content"] for r in own.collect()] == ["mine"] and none.count() == 0


def test_incremental_ingest(spark, tmp_path):
    src, store, check = (str(tmp_path / x) for x in ("src", "store", "check"))
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.txt").write_text("one")
    ingest_available(spark, src, store, check)
    (tmp_path / "src" / "b.txt").write_text("two")
    ingest_available(spark, src, store, check)
    ingest_available(spark, src, store, check)
    assert sorted(r["doc_content"] for r in stored_pages(spark, store).collect()) == ["one", "two"]


def test_datasets(spark, tmp_path):
    rows = spark.createDataFrame([("q, \"x\"\nline", ["a (page 1)"]), ("r", [])], "user_input string, source_files_with_pages array<string>")
    for path in tables.write_dataset(rows, str(tmp_path / "out")):
        got = tables.read_dataset(spark, path) if not path.endswith("json") else spark.read.json(path)
        assert got.count() == 2 and "user_input" in got.columns
    with pytest.raises(ValueError):
        tables.write_dataset(rows, str(tmp_path / "x"), ("xml",))
    (tmp_path / "d.json").write_text('[{"user_input": "a", "source_files_with_pages": "[]", "n": 1}]')
    assert tables.read_dataset(spark, str(tmp_path / "d.json")).first()["user_input"] == "a"
    (tmp_path / "e.csv").write_text("user_input\na\n")
    with pytest.raises(ValueError):
        tables.read_dataset(spark, str(tmp_path / "e.csv"))


def test_evaluation_files(spark, tmp_path):
    (tmp_path / "e.json").write_text(json.dumps({"per_query": [{"query": "a", "mrr": 0.5}, {"query": "b", "error": "no"}, {"query": "c"}, {"query": "d", "metrics": {"mrr": 1.0}}]}))
    assert [tuple(r) for r in tables.read_per_query(spark, str(tmp_path / "e.json"), "mrr").orderBy("pos").collect()] == [(0, "a", 0.5), (3, "d", 1.0)]


def test_profiles_personas_leaderboard(spark, tmp_path):
    text = json.dumps({"title_guess": "T", "topics": [f"t{i}" for i in range(20)], "key_entities": ["E"]})
    got = tables.parse_profiles(spark.createDataFrame([(text,)], "profile_json string")).select("profile", tables.format_profile().alias("f")).first()
    assert len(got["profile"]["topics"]) == 12 and got["f"].startswith("Title: T\nTopics: t0, t1")
    people = [{"name": "A", "role_description": "x"}, {"name": "A", "role_description": "y"}, {"name": "B", "role_description": "z"}]
    (tmp_path / "p.json").write_text(json.dumps({"personas": people}))
    (tmp_path / "l.json").write_text(json.dumps(people))
    (tmp_path / "p.jsonl").write_text("\n".join(map(json.dumps, people)))
    for name in ("p.json", "l.json", "p.jsonl"):
        assert [tuple(r) for r in tables.read_personas(spark, str(tmp_path / name)).collect()] == [("A", "x"), ("B", "z")]
    (tmp_path / "bad.jsonl").write_text('{"name": " "}')
    with pytest.raises(ValueError):
        tables.read_personas(spark, str(tmp_path / "bad.jsonl"))
    board = spark.createDataFrame([("k", 0.5, "old")], "config_key string, m double, run string")
    runs = spark.createDataFrame([("k", 0.5, "tie"), ("l", 0.1, "new")], "config_key string, m double, run string")
    assert {(r["config_key"], r["run"]) for r in tables.update_leaderboard(board, runs, "m").collect()} == {("k", "old"), ("l", "new")}
    tables.write_splits(spark.createDataFrame([(1, "train"), (2, "test")], "q long, split string"), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).filter(F.col("split") == "test").count() == 1


def test_xls_without_its_library(monkeypatch):
    """A missing library is told, not taken for an unreadable file."""
    import pytest

    from rankloom.sources import loaders

    monkeypatch.setattr(loaders.importlib.util, "find_spec", lambda name: None)
    with pytest.raises(LookupError):
        loaders.load_xls(b"", "a.xls")


def test_json_datasets_in_lines_and_arrays(spark, tmp_path):
    """What write_dataset() leaves is read whole, as are arrays on one line or over several."""
    from rankloom.sources import tables

    rows = spark.range(20).selectExpr("cast(id AS string) AS user_input", "'a (page 1)' AS source_files_with_pages").repartition(3)
    (path,) = tables.write_dataset(rows, str(tmp_path / "rows"), ("json",))
    assert tables.read_dataset(spark, path).count() == 20
    one = '{"user_input": "q", "source_files_with_pages": "s"}'
    for name, body in (("flat", f"[{one}, {one}]"), ("tall", f"\n[\n{one},\n{one}\n]\n"), ("lines", f"{one}\n{one}\n")):
        (tmp_path / f"{name}.json").write_text(body)
        assert tables.read_dataset(spark, str(tmp_path / f"{name}.json")).count() == 2
