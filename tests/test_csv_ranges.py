"""Parallel CSV reading against the plain reader, on small ranges."""

import random

import pytest

from dqloom.sources.csv_ranges import line_end, records
from dqloom.sources.text_csv import content_digest, find_encoding, read_rows, read_text


@pytest.fixture
def small_ranges(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def cell(r):
    plain = r.choice(["", "x", "é", "a b", " lead", 'in"side', "7" * r.randint(0, 80), "tail "])
    quoted = r.choice(["", "a,b", "line\nbreak", "two\n\nbreaks", 'say ""hi""', '""', "\n", ",", "crlf\r\nbreak", "long " * 60, '""\n""', "ü\nü"])
    return plain if r.random() < 0.5 else f'"{quoted}"'


@pytest.mark.parametrize("seed, ending", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_equal_to_the_plain_reader(spark, small_ranges, tmp_path, seed, ending):
    r = random.Random(seed)
    rows = [",".join(cell(r) for _ in range(4)) for _ in range(150)]
    rows = [x if x.strip(",") else "z,,," for x in rows]
    text = "﻿" * (seed == 1) + ending.join(["a,b,c,d", *rows[:70], "", *rows[70:], "short,row", "1,2,3,4,5,6"]) + ending * (seed != 3)
    path = str(tmp_path / "x.csv")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    for blank in (True, False):
        want = [tuple(x) for x in read_text(spark, path, keep_blank=blank).collect()]
        df = read_rows(spark, path, keep_blank=blank)
        assert df.columns == ["row_no", "a", "b", "c", "d"]
        got = sorted(tuple(x) for x in df.collect())
        assert [x[0] for x in got] == list(range(1, len(want) + 1))
        if ending == "\r\n":  # the plain reader then changes line breaks in cells, this one leaves them
            got = [tuple(v.replace("\r\n", "\n") if isinstance(v, str) else v for v in x) for x in got]
        assert [x[1:] for x in got] == want


def test_other_encodings_and_odd_files(spark, small_ranges, tmp_path):
    path = str(tmp_path / "w.csv")
    for name, data in (("cp1252", 'a;b\n"é;\n€";1\n' * 40), ("latin-1", "a;b\né;\x81\n" * 3)):
        with open(path, "wb") as f:
            f.write(data.encode(name))
        assert find_encoding(path) == name
        want = [tuple(x) for x in read_text(spark, path, ";", name, keep_blank=True).collect()]
        assert [tuple(x)[1:] for x in read_rows(spark, path, ";", name).orderBy("row_no").collect()] == want
    with open(path, "w") as f:
        f.write("a,b\n" + '1,"never closed\n' + "2,x\n" * 30)
    assert records(spark, path).count() == 2
    with open(path, "w") as f:
        f.write("a,b\n")
    assert read_rows(spark, path).count() == 0


def test_states():
    s, i = 3, 1
    assert [line_end(x, s, b",") for x in (b'"a', b'"a"', b'"a""', b'a"b', b'a,"b', b'"a"x,"', b"")] == [1, 0, 1, 0, 1, 1, 0]
    assert [line_end(x, i, b",") for x in (b"a", b'a"', b'a"",', b'a","b', b'""', b'"')] == [1, 0, 1, 1, 1, 0]


def test_encoding_and_digest_in_ranges(spark, small_ranges, tmp_path):
    lines = [f"{k},é{'x' * (k % 50)}" for k in range(300)]
    one, other = str(tmp_path / "1.csv"), str(tmp_path / "2.csv")

    def digest(data: bytes) -> str:
        with open(other, "wb") as f:
            f.write(data)
        return content_digest(spark, other)

    data = "\n".join(lines).encode()
    with open(one, "wb") as f:
        f.write(data)
    assert find_encoding(one) == "utf-8-sig"
    kept = content_digest(spark, one)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000000")
    assert digest(data) == kept  # whatever the ranges
    changed = [data + b"\n", data.replace(b"7,", b"8,", 1), "\n".join([*lines[:5], lines[6], lines[5], *lines[7:]]).encode(), b"\xef\xbb\xbf" + data]
    assert len({kept, *map(digest, changed)}) == 5
