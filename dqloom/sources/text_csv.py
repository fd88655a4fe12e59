"""CSV files whose cells are all read as text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqloom.sources.csv_ranges import PLAIN, read_ranges
from dqloom.sources.files import Place

ENCODINGS = ("utf-8-sig", "cp1252", "latin-1")
_JAVA = {"utf-8-sig": "UTF-8", "utf-8": "UTF-8", "cp1252": "windows-1252", "latin-1": "ISO-8859-1"}


def read_text(spark: SparkSession, path: str, delimiter: str = ",", encoding: str = "utf-8-sig", columns: list[str] | None = None, keep_blank: bool = False, one_line: bool = False) -> DataFrame:
    """Every column as text, an empty cell as null (or kept as ''); quoted line breaks stay in their cell. With columns, only those are parsed.
    one_line: no cell has a line break, so a large file is split over tasks (otherwise a file is one task; read_rows splits it all the same)."""
    if encoding == "cp1252":  # not among the character sets that Spark reads by default
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    reader = spark.read.options(header=True, sep=delimiter, encoding=_JAVA.get(encoding, encoding), multiLine=not one_line, quote='"', escape='"', inferSchema=False, mode="PERMISSIVE")
    if keep_blank:
        reader = reader.option("nullValue", "\u0000").option("emptyValue", "")
    df = reader.csv(path)
    df = df.select(*[(F.col(f"`{c}`") if keep_blank else F.when(F.col(f"`{c}`") != "", F.col(f"`{c}`"))).alias(c.lstrip("﻿")) for c in df.columns])
    return df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df


def _raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """The bytes between line feeds, from as many tasks as the file has ranges."""
    return spark.read.text(str(path), lineSep="\n").select(F.col("value"), F.col("value").cast("binary").alias("bytes"))


def find_encoding(path: str) -> str:
    """The first of ENCODINGS that the file's bytes are valid in. No sequence of theirs contains a line feed, so lines are judged one by one."""
    spark = SparkSession.active()
    missing = F.decode("bytes", "ISO-8859-1").rlike("[\\u0081\\u008D\\u008F\\u0090\\u009D]")  # what windows-1252 leaves undefined
    wrong = _raw_lines(spark, path).agg(F.max(~F.is_valid_utf8("value")).alias("utf8"), F.max(missing).alias("cp1252")).first()
    return ENCODINGS[0] if not wrong["utf8"] else ENCODINGS[1] if not wrong["cp1252"] else ENCODINGS[2]


def content_digest(spark: SparkSession, path: str) -> str:
    """A digest of a file of any size that tasks compute by ranges: the hashes of all lines with their numbers, added up, and the size in bytes.
    It is the same however the file is cut into ranges."""
    lines = numbered(_raw_lines(spark, path).select("bytes"))
    h = F.sha2(F.concat(F.col("row_no").cast("string").cast("binary"), F.lit(":").cast("binary"), "bytes"), 256)
    lanes = [F.coalesce(F.sum(F.conv(F.substring(h, 1 + 8 * k, 8), 16, 10).cast("decimal(38,0)")), F.lit(0)).cast("string") for k in range(8)]
    return lines.select("bytes", "row_no").agg(F.sha2(F.concat_ws(":", F.lit(str(Place(path, spark).size())), *lanes), 256)).first()[0]


def read_rows(spark: SparkSession, path: str, delimiter: str = ",", encoding: str = "utf-8-sig", keep_blank: bool = True) -> DataFrame:
    """As read_text, with row_no from 1 in front: a file is read by as many tasks as it has ranges, also where cells have line breaks."""
    plain = read_text(spark, str(path), delimiter, encoding, keep_blank=keep_blank)
    if encoding not in PLAIN or len(delimiter) != 1:
        return numbered(plain)
    options = {"sep": delimiter, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"} | ({"nullValue": "\u0000", "emptyValue": ""} if keep_blank else {})
    rows = read_ranges(spark, str(path), plain.columns, delimiter, encoding, options)
    return rows if keep_blank else rows.select("row_no", *[F.when(F.col(f"`{c}`") != "", F.col(f"`{c}`")).alias(c) for c in plain.columns])


def read_any_encoding(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """As read_text, with the encoding found from the bytes and blanks kept as ''."""
    return read_text(spark, path, delimiter, find_encoding(path), keep_blank=True)


def layout(df: DataFrame) -> tuple[list[str], int]:
    """Header and number of rows."""
    return df.columns, df.count()


def each_file(folder: str, work: Callable[[str], object]) -> tuple[dict[str, object], dict[str, str]]:
    """work on every CSV file below folder: results by file, and what went wrong by file; one bad file doesn't stop the others."""
    done, failed = {}, {}
    for path in files_below(folder):
        try:
            done[path] = work(path)
        except Exception as e:  # whatever a file does to its reader
            failed[path] = f"{type(e).__name__}: {e}".splitlines()[0]
    return done, failed


def files_below(folder: str) -> list[str]:
    return [p for p in Place(folder).files() if p.endswith(".csv")]


def numbered(df: DataFrame) -> DataFrame:
    """Rows with row_no, from 1 in the order of the input. Each partition's rows are numbered where they are; only the partitions' sizes (one
    row each) are brought together, so any number of rows can be numbered. df has to be read the same way twice, as a file is."""
    rows = df.select(F.monotonically_increasing_id().alias("_at"), "*")
    part, at = F.shiftright(F.col("_at"), 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("n"))
    before = sizes.select("_part", (F.expr("sum(n) over (order by _part)") - F.col("n")).alias("_before"))
    rows = rows.withColumn("_of", part).join(F.broadcast(before), F.col("_of") == F.col("_part"))  # as many rows as partitions
    return rows.select((F.col("_before") + at + 1).alias("row_no"), *[F.col(f"`{c}`") for c in df.columns])


def with_record_ids(df: DataFrame, prefix: str, width: int, row_no: str = "row_no") -> DataFrame:
    n = F.col(row_no).cast("string")
    padded = F.when(F.length(n) < width, F.lpad(n, width, "0")).otherwise(n)
    return df.withColumn("record_id", F.concat(F.lit(prefix), padded))


def write_text(df: DataFrame, path: str, delimiter: str = ",") -> None:
    """A folder of CSV files, one for each partition."""
    df.write.mode("overwrite").options(header=True, sep=delimiter, quote='"', escape='"').csv(path)


def export_file(df: DataFrame, path: str, for_spreadsheets: bool = False) -> int:
    """One CSV file on the driver, for people; rows come one at a time. With a byte-order mark if spreadsheets should read it."""
    import csv

    n = 0
    with open(path, "w", encoding="utf-8-sig" if for_spreadsheets else "utf-8", newline="") as f:
        out = csv.writer(f)
        out.writerow(df.columns)
        for row in df.toLocalIterator():
            out.writerow(["" if v is None else v for v in row])
            n += 1
    return n


def missing_and_extra(df: DataFrame, declared: list[str], generated: list[str]) -> tuple[list[str], list[str]]:
    """Declared columns that a file lacks (generated ones may be missing), and columns that are not declared."""
    have = set(df.columns)
    return [c for c in declared if c not in have and c not in generated], [c for c in df.columns if c not in declared]
