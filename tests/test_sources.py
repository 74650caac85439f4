from __future__ import annotations

import codecs
import io
import lzma
import zipfile

import pytest
from pyspark.sql import functions as F

from cohortlake.sources import decoded, dialect, files
from cohortlake.sources.workbook import sheet_rows
from cohortlake.workload.source_queries import _workbook


@pytest.mark.parametrize("cut", [1, 2, 3])
def test_a_sample_may_end_inside_a_character(cut):
    for letter in ("ß", "→", "𝄞"):
        raw = ("plain " * 9 + letter).encode()
        if cut < len(letter.encode()):
            assert dialect.encoding_of(raw[:-cut]) == "utf-8"


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        (b"", "utf-8"),
        (b"tree,height\noak,30\n", "utf-8"),
        (codecs.BOM_UTF8 + "größe".encode(), "utf-8-sig"),
        (codecs.BOM_UTF16_BE + "größe".encode("utf-16-be"), "utf-16"),
        (codecs.BOM_UTF16_LE + "größe".encode("utf-16-le"), "utf-16"),
        (b"gr\xf6\xdfe \x80 5", "cp1252"),
        (b"gr\xf6\xdfe \x9d 5", "latin-1"),
    ],
)
def test_encoding(raw, expected):
    assert dialect.encoding_of(raw) == expected


@pytest.mark.parametrize("mark", dialect.DELIMITERS)
def test_every_delimiter_among_quoted_others(mark):
    others = "".join(d for d in dialect.DELIMITERS if d != mark)
    lines = ["tree", "height", "note"], ["oak", "30", f'"{others}"'], ["elm", "7", f'"say ""{mark}"" {others}"'], ["fir", "12", '"two\nlines"']
    text = "\n".join(mark.join(r) for r in lines) + "\n"
    assert dialect.delimiter_of(text) == mark
    records = dialect.sample_records(text, mark)
    assert [len(r) for r in records] == [3] * 4
    assert records[2][2] == f'say "{mark}" {others}' and records[3][2] == "two\nlines"


def test_delimiter_ties_and_defaults():
    assert dialect.delimiter_of("") == ","
    assert dialect.delimiter_of("lonely\nwords\n") == ","
    assert dialect.delimiter_of("a|b;c\nd|e;f\n") == ";"  # equal in share and width: the first mark
    assert dialect.delimiter_of("a|b;c;d\ne|f;g;h\n") == ";"  # wider
    assert dialect.delimiter_of("a;b|c|d\ne;f\ng;h\n") == ";"  # larger share


def test_records_of_a_cut_sample():
    assert dialect.sample_records("a,b\nc,d\ne", ",") == [["a", "b"], ["c", "d"]]
    assert dialect.sample_records("a,b", ",") == [["a", "b"]]
    assert dialect.sample_records("a,b\r\n\r\n,\r", ",") == [["a", "b"], [], ["", ""]]
    assert len(dialect.sample_records("x,y\n" * 90, ",")) == dialect.SAMPLE_RECORDS


TITLES = [["Forest survey", None], [], ["of", "2026"]]
TABLE = [["tree", "height", "age", "site"], ["oak", 30, 120, "north"], ["elm", 7.5, 14, "south"]]


@pytest.mark.parametrize(
    ("rows", "expected"),
    [
        (TABLE, 0),
        (TITLES + TABLE, 3),
        ([["tree", "site"], ["oak", "north"], ["elm", "south"]], 0),
        ([*TITLES, ["tree", "height", "age", "site"]], 3),
        ([["alone"], ["also"]], 0),
        ([], 0),
        ([TABLE[0], [], *TABLE[1:]], 0),
        ([["a", "b", "c"], [], ["tree", "height", "age"], ["oak", "12%", "R$ 1,50"]], 2),
        (TABLE[1:], 0),
    ],
)
def test_header_row(rows, expected):
    assert dialect.header_row(rows) == expected


def test_numeric_cells(spark):
    yes = ["7", "+7", "-0.25", "1.000.000", "1,000.5", "99%", "R$ 3", "R$5,10", "1999-12-31", "31.12.99 noon"]
    no = ["", "7 m", "R$", "1_000", "--3", "12:30", "Ⅷ", "e5"]
    df = spark.createDataFrame([(c,) for c in yes + no], "c string")
    got = [r[0] for r in df.select(dialect.numeric_like(F.col("c"))).collect()]
    assert got == [True] * len(yes) + [False] * len(no)
    assert got == [bool(dialect._is_number(c)) for c in yes + no]


def test_csv_headers_follow_the_readers_naming():
    assert dialect.csv_header(["tree", "", "tree", "", "tree"]) == ["tree", "Unnamed: 1", "tree.1", "Unnamed: 3", "tree.2"]


def _files(spark, items):
    return spark.createDataFrame(items, "file_uri string, file_name string, content binary")


def test_listing_names(spark):
    names = ["oak.dat", "ELM.DAT", ".fir.dat", "~$ash.dat", "yew.dat.part", "notes.txt", "a.b.dat"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    kept = df.where(files.accepted(F.col("n"), ["*.dat", "*.part"])).collect()
    assert [r[0] for r in kept] == ["oak.dat", "ELM.DAT", "a.b.dat"]


def _zip(members):
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)
    return blob.getvalue()


def test_archive_members():
    names = ["north/", "north/Oak.CSV", "south/oak.csv", "south/elm.csv", "south/.hidden.csv", "read.me"]
    pick = lambda **o: decoded.archive_names(names, decoded.DecodeOptions(**o))
    assert pick() == ["north/Oak.CSV", "read.me", "south/elm.csv", "south/oak.csv"]
    assert pick(member_pattern="*OAK*") == ["north/Oak.CSV", "south/oak.csv"]
    assert pick(member_pattern="south/*", exclude=("e*",)) == ["south/.hidden.csv", "south/oak.csv"]
    assert pick(members=("NORTH/oak.csv", "absent")) == ["north/Oak.CSV"]
    assert pick(member_pattern="*.xml") == []


def test_archives_and_codecs(spark):
    packed = [
        ("z", "trees.zip", _zip({"b.csv": "tree|height\nelm|\n", "a.csv": "tree|height\noak|30\n", "c.part": "x\n"})),
        ("x", "trees.csv.xz", lzma.compress("tree;height\nfir;12\n".encode())),
    ]
    rows = decoded.decode_files(_files(spark, packed))
    assert decoded.record_columns(rows) == ["tree", "height"]
    got = rows.orderBy("file_uri", "member", "row_no").collect()
    assert [(r["member"], r["record"]) for r in got] == [
        (None, {"tree": "fir", "height": "12"}),
        ("a.csv", {"tree": "oak", "height": "30"}),
        ("b.csv", {"tree": "elm", "height": None}),
    ]
    with pytest.raises(Exception, match="no member matches"):
        decoded.decode_files(_files(spark, packed[:1]), decoded.DecodeOptions(member_pattern="*.json")).count()


def test_workbook_layouts(spark):
    rows = [*TITLES, ["tree", None, "age", "site", None], ["oak", "tall", 120, "north", "beyond"], [None, "lone note"], [], ["elm", None, 14.5, None]]
    book = _workbook([[c for c in r] for r in rows])
    assert next(sheet_rows(io.BytesIO(book), 0)) == ["hidden"]
    records = lambda **o: [r["record"] for r in decoded.decode_files(_files(spark, [("w", "w.xlsx", book)]), decoded.DecodeOptions("xlsx", sheet="auto", **o)).orderBy("row_no").collect()]
    oak = {"tree": "oak", "col_2": "tall", "age": "120", "site": "north"}
    elm = {"tree": "elm", "col_2": None, "age": "14.5", "site": None}
    note = {"tree": None, "col_2": "lone note", "age": None, "site": None}
    assert records(skip_rows=3) == [oak, note, elm]
    assert records(skip_rows="auto", drop_note_rows=True) == [oak, elm]
    with pytest.raises(Exception, match="no header in the first 2 rows"):
        records(skip_rows="auto", header_rows=2)


def test_long_fields_are_read_whole(spark):
    text = "leaf " * 60000
    rows = decoded.decode_files(_files(spark, [("f", "f.csv.xz", lzma.compress(f"id,t\n1,{text}\n".encode()))]))
    assert rows.first()["record"]["t"] == text
