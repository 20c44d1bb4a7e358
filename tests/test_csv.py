import io
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusloom.sources import csv_files

FILES = {
    "latin.csv": "name,n\ncaf\xe9,1\nx,2\n".encode("latin-1"),
    "utf.csv": 'name,n,note\n"Müller, A",7,"say ""hi"""\n☃,-3,\n'.encode(),
    "kinds.csv": b"i,r,m,b,c,t,e,w\n1,1.5,1,True,True,a,,1\n+2,-2e3,NA,false,,1,,1.5\n3,.5,3,TRUE,False,b,,x\n",
    "head.csv": b"a,b\n",
    "twice.csv": b"a,,a,a\n1,2,3,4\n",
    "same.csv": b"k,v\nk,v\nk,v\n1,2\n",
    "blank.csv": b"\n\nx,y\n\n1,2\n\n",
    "windows.csv": b"x,y\r\n1,p\r\n2,q\r\n",
    "bom.csv": "﻿x,y\n1,é\n".encode(),
    "few.csv": b"a,b,c\n1\n1,2\n",
}


def expected(data: bytes) -> pd.DataFrame:
    try:
        return pd.read_csv(io.BytesIO(data))
    except UnicodeDecodeError:
        return pd.read_csv(io.BytesIO(data), encoding="latin-1")


@pytest.fixture
def folder(tmp_path):
    for name, data in FILES.items():
        (tmp_path / name).write_bytes(data)
    (tmp_path / "empty.csv").write_bytes(b"")
    return str(tmp_path)


def test_each_file_has_its_own_profile(spark, folder):
    rows = {os.path.basename(r["source_path"]): r for r in csv_files.csv_profile(spark, folder).collect()}
    assert set(rows) == set(FILES)
    for name, data in FILES.items():
        frame, row = expected(data), rows[name]
        assert (row["rows"], row["columns"]) == frame.shape, name
        assert row["column_names"] == list(frame.columns), name
        assert row["dtypes"] == ["object" if str(t) in ("object", "str") else str(t) for t in frame.dtypes], name
        assert row["malformed"] == 0
    assert [n for n, r in rows.items() if not r["utf8"]] == ["latin.csv"]


@pytest.mark.parametrize("block", ["7b", "1g"])
def test_values_of_mixed_layouts_and_encodings(spark, folder, block):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    # Files cut into parts of few bytes have their head line in the first part only.
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        rows = csv_files.csv_records(spark, folder).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    found = {}
    for r in rows:
        found.setdefault(os.path.basename(r["source_path"]), []).append(tuple(v or "" for v in r["values"]))
    for name, data in FILES.items():
        try:
            text = data.decode("utf-8-sig")
        except UnicodeDecodeError:
            text = data.decode("latin-1")
        frame = pd.read_csv(io.StringIO(text), dtype=str, keep_default_na=False, na_filter=False).fillna("")
        assert sorted(found.get(name, [])) == sorted(map(tuple, frame.to_numpy().tolist())), name


def test_one_table_of_several_layouts(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("n,name\n1,caf\xe9\n,x\n".encode("latin-1"))
    (tmp_path / "b.csv").write_bytes("name,extra\né,2.5\nNA,3\n".encode())
    table = csv_files.csv_rows(spark, str(tmp_path))
    assert dict(table.dtypes) == {"n": "bigint", "name": "string", "extra": "double"}
    assert {tuple(r[c] for c in ("n", "name", "extra")) for r in table.collect()} == {
        (1, "caf\xe9", None), (None, "x", None), (None, "é", 2.5), (None, None, 3.0)}
    told = csv_files.csv_rows(spark, str(tmp_path), "extra int, name string, gone date")
    assert told.columns == ["extra", "name", "gone"]
    assert {(r["extra"], r["name"]) for r in told.collect()} == {(None, "caf\xe9"), (None, "x"), (None, "é"), (3, None)}


def test_long_lines_are_told(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"a,b\n1,2,3\n4,5\n")
    (tmp_path / "wide.csv").write_bytes(b"a,b,c,d\n1,2,3,4\n")
    rows = csv_files.csv_profile(spark, str(tmp_path)).collect()
    assert {os.path.basename(r["source_path"]): (r["rows"], r["malformed"]) for r in rows} == {"a.csv": (2, 1), "wide.csv": (1, 0)}


def test_documents_are_records(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes('name,n\n"a, b",1\n"q""q",\n'.encode())
    assert {r["content"] for r in csv_files.csv_documents(spark, str(tmp_path)).collect()} == {'"a, b",1', '"q""q",'}
    (tmp_path / "t.csv").write_bytes(b'name,n\n"two\nlines",1\n')
    content = csv_files.csv_records(spark, str(tmp_path), multiline=True).select(F.get("values", F.lit(0))).first()[0]
    assert content == "two\nlines"


def test_no_files_with_lines(spark, tmp_path):
    (tmp_path / "e.csv").write_bytes(b"\n \n")
    assert csv_files.csv_profile(spark, str(tmp_path)).collect() == []
    assert csv_files.csv_documents(spark, str(tmp_path)).collect() == []
