import io
import json
import os
import zipfile

from pyspark.sql import functions as F

from corpusloom.sources import files

WORD = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def write(path, data):
    with open(path, "wb") as out:
        out.write(data)


def name(row):
    return os.path.basename(row["source_path"])


def test_text_files(spark, tmp_path):
    write(tmp_path / "a.txt", "één\r\ntwee  drie\n".encode())
    write(tmp_path / "b.md", "hi ☃".encode("utf-16"))
    write(tmp_path / "c.markdown", "caf\xe9s".encode("latin-1"))
    write(tmp_path / "d.txt", b"")
    write(tmp_path / "e.bin", b"skipped")
    rows = {name(r): r for r in files.text_documents(spark, str(tmp_path)).collect()}
    assert set(rows) == {"a.txt", "b.md", "c.markdown"}
    assert (rows["a.txt"]["content"], rows["a.txt"]["encoding"], rows["a.txt"]["lines_count"]) == (
        "één twee drie", "utf-8", 2)
    assert (rows["b.md"]["content"], rows["b.md"]["encoding"]) == ("hi ☃", "utf-16")
    assert rows["b.md"]["is_markdown"] and not rows["a.txt"]["is_markdown"]
    assert (rows["c.markdown"]["content"], rows["c.markdown"]["encoding"]) == ("caf\xe9s", "latin-1")


def test_html_files(spark, tmp_path):
    write(tmp_path / "p.html", b"<html lang='de'><title>T</title><article>Ein kurzer Text.</article></html>")
    row = files.html_documents(spark, str(tmp_path)).first()
    assert (row["title"], row["content"], row["source_type"], row["language"]) == (
        "T", "Ein kurzer Text.", "html", "de")
    assert row["metadata"]["response_status"] is None


def test_html_files_that_fail_are_rows(spark, tmp_path):
    write(tmp_path / "good.html", b"<title>T</title><article>A text.</article>")
    write(tmp_path / "bad.html", b"<![foo[bar]]><article>A text.</article>")
    rows = {r["source_path"].rsplit("/", 1)[1]: r for r in files.html_documents(spark, str(tmp_path)).collect()}
    assert rows["good.html"]["error"] is None and rows["good.html"]["content"] == "A text."
    assert rows["bad.html"]["error"] and rows["bad.html"]["content"] is None


def test_json(spark, tmp_path):
    values = {"o.json": {"b": [1], "a": "é"}, "l.json": [{"k": 1}, 2], "e.json": [], "s.json": "x"}
    for file, value in values.items():
        write(tmp_path / file, json.dumps(value).encode())
    write(tmp_path / "bad.json", b"{nope")
    rows = {name(r): r for r in files.json_documents(spark, str(tmp_path)).collect()}
    assert set(rows) == set(values)
    for file, value in values.items():
        assert rows[file]["content"] == json.dumps(value, indent=2, ensure_ascii=False)
    assert rows["o.json"]["json_structure"].asDict() == {
        "type": "object", "keys": ["b", "a"], "key_count": 2, "length": None, "item_type": None}
    assert rows["l.json"]["json_structure"]["length"] == 2
    assert rows["l.json"]["json_structure"]["item_type"] == "dict"
    assert rows["e.json"]["json_structure"]["item_type"] is None
    assert rows["s.json"]["json_structure"]["type"] == "str"


def test_json_type_names(spark):
    values = ["[1]", "[1.5]", "[1e3]", "[true]", "[null]", '["s"]', "[[1]]", "[123456789012345678901234567890]"]
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    found = [r[0] for r in frame.select(files.json_structure(F.col("v"))["item_type"]).collect()]
    assert found == [type(json.loads(v)[0]).__name__ for v in values]


def docx(paragraphs, rows, title):
    def paragraph(text):
        return f"<w:p><w:r><w:t>{text}</w:t></w:r></w:p>"

    cells = "".join(
        "<w:tr>" + "".join(f"<w:tc>{paragraph(c)}</w:tc>" for c in row) + "</w:tr>" for row in rows
    )
    body = "".join(map(paragraph, paragraphs)) + f"<w:tbl>{cells}</w:tbl>"
    core = (
        '<cp:coreProperties xmlns:cp="http://schemas.openxmlformats.org/package/2006/metadata/core-properties"'
        f' xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:title>{title}</dc:title></cp:coreProperties>'
    )
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        archive.writestr("word/document.xml", f'<w:document xmlns:w="{WORD}"><w:body>{body}</w:body></w:document>')
        archive.writestr("docProps/core.xml", core)
    return buffer.getvalue()


def test_docx(spark, tmp_path):
    write(tmp_path / "a.docx", docx(["One  two", " ", "Three"], [["a", " b "], ["c", ""]], "Ti"))
    write(tmp_path / "broken.docx", b"no zip")
    rows = {name(r): r for r in files.docx_documents(spark, str(tmp_path)).collect()}
    good = rows["a.docx"]
    assert good["paragraphs"] == ["One two", "Three"] and good["tables"] == ["a | b\nc |"]
    assert good["content"] == "One two\nThree\na | b\nc |"
    assert (good["paragraph_count"], good["table_count"], good["title"], good["author"]) == (2, 1, "Ti", "")
    assert rows["broken.docx"]["error"] and good["error"] is None


def test_pdf_pages(spark):
    rows = [("d", 3, "third  page"), ("d", 1, " first\n"), ("d", 2, ""), ("e", 1, None), ("f", 1, " ")]
    frame = spark.createDataFrame(rows, "source_path string, page_number int, text string")
    found = {r["source_path"]: r for r in files.pdf_documents(frame).collect()}
    assert set(found) == {"d", "f"}
    row = found["d"]
    assert row["content"] == "first\n\nthird page"
    assert [(p["page_number"], p["content"]) for p in row["pages"]] == [(1, "first"), (3, "third page")]
    assert (row["page_count"], row["word_count"], row["char_count"]) == (2, 3, len("first\n\nthird page\n\n"))


def test_inventory(spark, tmp_path):
    for i, size in enumerate((10, 2048)):
        write(tmp_path / f"f{i}.json", b"x" * size)
        os.utime(tmp_path / f"f{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    write(tmp_path / "other.txt", b"x")
    listed = files.inventory(spark, str(tmp_path))
    assert [r["filename"] for r in listed.collect()] == ["f1.json", "f0.json"]
    totals = files.inventory_totals(listed).first()
    assert (totals["total_files"], totals["total_bytes"]) == (2, 2058)
    assert abs(totals["total_size_mb"] - 2058 / 1048576) < 1e-12


def test_route(spark):
    frame = spark.createDataFrame([("http://x/y.csv",), ("z/y.csv",)], "path string")
    assert [r["reader"] for r in files.route(frame).collect()] == ["web", "csv"]
