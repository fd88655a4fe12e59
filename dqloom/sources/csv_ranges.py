"""CSV files with line breaks in cells, read in parallel by ranges of the file.

Lines come from Spark's text reader, which splits a file at line ends wherever they are. Whether a line starts inside a cell depends on all lines
before it, but what a line does is a function of two states: it ends outside or inside a cell, given how it starts. Such functions compose, so
each range is summed up to one row (how it ends and how many records begin in it, for both starts), those rows are chained, and then every range knows how
it starts and the number of its first record. A second pass cuts the ranges into records; only the one record that crosses the end of a range is put
together from pieces. Records become cells by from_csv, with the options of the plain reader.

A quote opens a cell only at the cell's start, is doubled inside, and is text elsewhere, as in the plain reader. Records end at a line feed,
with or without a carriage return (inside cells both stay as they are); empty lines are no records; a quote that is never closed takes the rest of the file into one cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Encodings in which line feed, quote and delimiter are one byte each that means nothing else.
PLAIN = ("utf-8-sig", "utf-8", "cp1252", "latin-1")
OUTSIDE, INSIDE, CLOSED, START = range(4)


def line_end(line: bytes, state: int, delimiter: bytes) -> int:
    """INSIDE if the line, begun at START or INSIDE, ends within a cell."""
    if b'"' not in line:
        return INSIDE if state == INSIDE else OUTSIDE
    for before in line.split(b'"')[:-1]:
        if state == INSIDE:
            state = CLOSED
        elif (state in (CLOSED, START) and not before) or before.endswith(delimiter):
            state = INSIDE
        else:
            state = OUTSIDE
    return INSIDE if state == INSIDE else OUTSIDE


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, lineSep="\n").select(F.col("value").cast("binary").alias("line"), F.col("_metadata.file_block_start").alias("range"))


def _by_line(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    for batch in batches:
        for line, at in zip(batch.column(0), batch.column(1).to_pylist()):
            yield at, line.as_py()


def _summed(lines: DataFrame, delimiter: bytes) -> list[tuple[int, int, int, int, int]]:
    """For each range: its start, and end state and number of records that begin, if it starts outside and if it starts inside."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: dict[int, list[int]] = {}
        for at, line in _by_line(batches):
            now = done.setdefault(at, [START, 0, INSIDE, 0])
            blank = line in (b"", b"\r")
            for k in (0, 2):
                if now[k] != INSIDE and not blank:
                    now[k + 1] += 1
                now[k] = INSIDE if line_end(line, INSIDE if now[k] == INSIDE else START, delimiter) == INSIDE else START
        yield pa.RecordBatch.from_pylist([dict(zip(("range", "a", "n_a", "b", "n_b"), (k, *v))) for k, v in done.items()], schema=pa.schema([(c, pa.int64()) for c in ("range", "a", "n_a", "b", "n_b")]))

    rows = lines.mapInArrow(run, "range long, a long, n_a long, b long, n_b long").collect()  # one row for each range
    return sorted(tuple(r) for r in rows)


def records(spark: SparkSession, path: str, delimiter: str = ",", encoding: str = "utf-8-sig") -> DataFrame:
    """Rows (record_no from 0, record): the header is record 0."""
    lines, sep = _lines(spark, path), delimiter.encode(encoding.removesuffix("-sig"))
    starts, state, n = {}, START, 0
    for at, a, n_a, b, n_b in _summed(lines, sep):
        starts[at] = (state, n)
        state, n = (b, n + n_b) if state == INSIDE else (a, n + n_a)
    codec = encoding.removesuffix("-sig")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows):
            no, part, piece, whole = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(no, pa.int64()), pa.array(part, pa.int64()), pa.array(piece, pa.string()), pa.array(whole, pa.bool_())], ["record_no", "part", "piece", "whole"])

        def made(no, part, held, whole):
            text = b"\n".join(held)
            return no, part, text.decode(codec, "replace"), whole

        out, size, at, state, no, held, crossing = [], 0, None, START, 0, [], False
        for where, line in _by_line(batches):
            if where != at:
                if held:
                    out.append(made(no - 1, at, held, False))
                at, (state, no), held = where, starts[where], []
                crossing = state == INSIDE
            if state != INSIDE and not held:
                if line in (b"", b"\r"):
                    continue
                no += 1
            held.append(line)
            state = INSIDE if line_end(line, INSIDE if state == INSIDE else START, sep) == INSIDE else START
            size += len(line)
            if state != INSIDE:
                if held[-1].endswith(b"\r"):
                    held[-1] = held[-1][:-1]
                out.append(made(no - 1, at, held, not crossing))
                held, crossing = [], False
            if size > 1 << 22:
                yield batch(out) if out else batch([(0, 0, "", None)]).slice(0, 0)
                out, size = [], 0
        if held:
            out.append(made(no - 1, at, held, False))
        if out:
            yield batch(out)

    pieces = lines.mapInArrow(run, "record_no long, part long, piece string, whole boolean")
    crossing = pieces.filter("not whole").groupBy("record_no").agg(F.sort_array(F.collect_list(F.struct("part", "piece"))).alias("p"))
    crossing = crossing.select("record_no", F.concat_ws("\n", "p.piece").alias("record"))
    found = pieces.filter("whole").select("record_no", F.col("piece").alias("record")).unionByName(crossing)
    return found.withColumn("record", F.expr("if(record_no = 0 and startswith(record, '\\ufeff'), substring(record, 2), record)"))


def read_ranges(spark: SparkSession, path: str, columns: list[str], delimiter: str, encoding: str, options: dict[str, str]) -> DataFrame:
    """Rows (row_no from 1, the columns) of a file with a header, all as text."""
    schema = ", ".join(f"`c{i}` string" for i in range(len(columns)))
    cells = records(spark, path, delimiter, encoding).filter("record_no > 0")
    cells = cells.select(F.col("record_no").alias("row_no"), F.from_csv("record", schema, options).alias("c"))
    return cells.select("row_no", *[F.col(f"c.c{i}").alias(name) for i, name in enumerate(columns)])
