"""Reading of files: hashes by block, the listing index, quotes over line ends, surplus fields, plain sessions."""

from __future__ import annotations

import csv
import gzip
import hashlib
import io
import os
import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlake.plans.landing import Lake, Source
from cohortlake.sources import delimited, quoted, streamed
from cohortlake.sources.decoded import DecodeOptions


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    return folder


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of a few lines."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]

    def use(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield use
    for name, value in zip(names, old, strict=True):
        spark.conf.set(name, value)


def aged(path, seconds=3600):
    past = path.stat().st_mtime - seconds
    os.utime(path, (past, past))


def text_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [str(v) for v in r])


def test_the_session_needs_no_setting_for_western_files(spark):
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == "false"


def test_every_western_byte(lake, landing):
    defined = bytes(b for b in range(0x20, 0x100) if b not in b'",' and bytes([b]).decode("cp1252", "ignore"))
    (landing / "a.csv").write_bytes(b"k,v\n1," + defined + b"\n")
    (landing / "b.csv").write_bytes(b'k,v\n2,"\x80\n\x93x\x94"\n')
    source = Source("west", str(landing), decode=DecodeOptions(sep=","))
    lake.load(source)
    got = text_rows(lake.bronze(source).select("k", "v"))
    assert got == [("1", defined.decode("cp1252")), ("2", "€\n“x”")]


@pytest.mark.parametrize("text", ["a,b\n1,2\n5,6,,9\n7\n", 'a,b\n"1\n1",2\n5,"6",,"9"\n7\n'])
def test_surplus_fields_stop_every_use_of_the_rows(spark, lake, landing, text):
    file = landing / "wide.csv"
    file.write_text(text)
    rows = delimited.read_layout(spark, [str(file)], ["a", "b"], ",", "utf-8", split_safe='"' not in text)
    for use in (rows, rows.select("a"), rows.select("_source_file"), rows.groupBy("b").count()):
        with pytest.raises(Exception, match="wider than its header"):
            use.collect()
    with pytest.raises(Exception, match="wider than its header"):
        rows.count()
    for columns in (["a"], ["b"]):
        steps = ({"op": "select_columns", "columns": columns},)
        with pytest.raises(Exception, match="wider than its header"):
            lake.load(Source("wide", str(landing), decode=DecodeOptions(sep=","), steps=steps))
    assert lake.ops.read("file_manifest").count() == 0


def test_quoted_fields_across_every_border(spark, tmp_path, small_ranges):
    draw = random.Random(3)
    bits = ["a", "bb", '"', "\n", ",", ";", "é", " ", "x\r\ny", '""', "long words here "]
    paths, want = [], []
    for i, (end, style) in enumerate([("\n", csv.QUOTE_MINIMAL), ("\r\n", csv.QUOTE_ALL), ("\n", csv.QUOTE_ALL)]):
        text = io.StringIO()
        writer = csv.writer(text, lineterminator=end, quoting=style)
        # the header runs over lines, too
        writer.writerow(["title\nover lines"])
        writer.writerow(["id", "the\nfirst", "b", "c"])
        rows = [[f"{i}.{n}", *("".join(draw.choices(bits, k=draw.randint(0, 9))) for _ in range(3))] for n in range(60)]
        writer.writerows(rows)
        path = tmp_path / f"{i}.csv"
        path.write_bytes(text.getvalue().encode())
        paths.append(str(path))
        want += [tuple(v or None for v in r) for r in rows]
    for size in (37, 400, 1 << 20):
        small_ranges(size)
        got = delimited.read_layout(spark, paths, ["id", "a", "b", "c"], ",", "utf-8", skip=1, split_safe=False)
        assert text_rows(got.drop("_source_file")) == sorted(want, key=lambda r: [str(v) for v in r])


def test_unusual_quoting(spark, tmp_path, small_ranges):
    path = tmp_path / "q.csv"
    path.write_text('a|b\n5" pipe|x"y"z\n""|"q""|""q"\n"in\n\n|\nside"|\n   \n\n|"never closed\nto the end')
    want = [("5\" pipe", 'x"y"z'), (None, 'q"|"q'), ("in\n\n|\nside", None), (None, "never closed\nto the end")]
    for size in (5, 1 << 20):
        small_ranges(size)
        got = delimited.read_layout(spark, [str(path)], ["a", "b"], "|", "utf-8", split_safe=False)
        assert text_rows(got.drop("_source_file")) == sorted(want, key=lambda r: [str(v) for v in r])


def test_line_states_chain():
    draw = np.random.default_rng(1)
    for _ in range(50):
        outside, inside = draw.random(30) < 0.3, draw.random(30) < 0.7
        for start in (False, True):
            states, state = [], start
            for a, b in zip(outside, inside, strict=True):
                states.append(state)
                state = bool(b if state else a)
            before, end = quoted.states_before(outside, inside, start)
            assert before.tolist() == states and end == state


def test_gzip_with_quoted_line_ends(lake, landing):
    (landing / "a.csv.gz").write_bytes(gzip.compress(b'k,v\n1,"x\ny"\n2,z\n'))
    source = Source("gz", str(landing))
    lake.load(source)
    assert text_rows(lake.bronze(source).select("k", "v")) == [("1", "x\ny"), ("2", "z")]


def test_digest_by_block_equals_whole(tmp_path):
    content = ('k,v\n' + "".join(f'{i},"a b {i}"\n' for i in range(2000))).encode()
    path = tmp_path / "a b%20c.csv"
    path.write_bytes(content)
    for size in (1, 7, 1 << 20) if len(content) < 1 << 16 else (7, 1 << 20):
        sha256, safe, head = streamed.digest(f"file:{path}", None, block_bytes=size)
        assert sha256 == hashlib.sha256(content).hexdigest() and safe and content.startswith(head)
    path.write_bytes(content + b'x,"open\nfield"\n')
    assert not streamed.digest(str(path), None, block_bytes=7)[1]
    packed = tmp_path / "p.csv.gz"
    packed.write_bytes(gzip.compress(content))
    assert streamed.digest(str(packed), "gzip", block_bytes=100)[2] == content[: 1 << 20]


def test_a_large_file_is_hashed_in_little_memory(tmp_path):
    """A sparse file beyond what a cell can hold (2 GB)."""
    path = tmp_path / "large.csv"
    size = (2 << 30) + 5
    with path.open("wb") as file:
        file.write(b"k,v\n1,2\n")
        file.truncate(size)
    tracemalloc.start()
    sha256, safe, head = streamed.digest(str(path), None)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert safe and len(head) == 1 << 20 and len(sha256) == 64
    assert peak < 12 * streamed.BLOCK_BYTES


def test_unchanged_files_are_not_opened_again(lake, landing, monkeypatch):
    source = Source("felled", str(landing), decode=DecodeOptions(sep=","))
    for name in ("a", "b"):
        (landing / f"{name}.csv").write_text(f"k,v\n{name},1\n")
        aged(landing / f"{name}.csv")
    assert lake.load(source)["files_opened"] == 2
    again = lake.load(source)
    assert (again["files_opened"], again["units_skipped"], again["rows_loaded"]) == (0, 2, 0)
    (landing / "b.csv").write_text("k,v\nb,22\n")
    aged(landing / "b.csv", 1800)
    (landing / "copy of a.csv").write_text("k,v\na,1\n")
    third = lake.load(source)
    assert (third["files_opened"], third["units_skipped"], third["rows_loaded"]) == (2, 2, 1)
    # a just written file may change once more within the same second: it is read again
    (landing / "young.csv").write_text("k,v\ny,1\n")
    assert [lake.load(source)["files_opened"] for _ in range(2)][0] >= 1
    # other reading options are another entry
    other = Source("other", str(landing), decode=DecodeOptions(sep=",", quote="'"))
    assert lake.load(other)["files_opened"] == 4
    assert text_rows(lake.bronze(source).select("k", "v")) == [("a", "1"), ("b", "1"), ("b", "22"), ("y", "1")]


def test_index_keeps_the_dialect(lake, landing):
    (landing / "a.csv").write_bytes("Titel\n\nk;v\n1;größer\n".encode("cp1252"))
    aged(landing / "a.csv")
    source = Source("full", str(landing), strategy="full", decode=DecodeOptions(skip_rows="auto"))
    first = lake.load(source)
    second = lake.load(source)
    assert (first["files_opened"], second["files_opened"], second["rows_loaded"]) == (1, 0, 1)
    assert lake.bronze(source).select("v").first()["v"] == "größer"
    assert lake.bronze(source).agg(F.count(F.lit(1))).first()[0] == 1
