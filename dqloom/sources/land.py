"""Landing source files as immutable batches, and the folders in which a run's tables are kept.

A batch is prepared in a hidden folder: the file's bytes (hashed while they are copied, and again as they lie there), its rows as Parquet with
their number in the file, and a manifest. Creating a file of the batch's id, which only one can do, claims the id; renaming the folder to it publishes
all of it at once. The CSV is parsed once, at landing; whatever reads a batch reads the Parquet rows, in parallel. Roots are paths of any file system
that Spark writes to.

Tables of a run live under <root>/<dataset>/<run>/<table>[/round=n or /at=n]. The document of a step (documents/<marker>.json) is written last and
is what publishes the step's tables: readers leave out parts whose marker is missing, and the next attempt of the step replaces them. What
is published is never rewritten.
"""

from __future__ import annotations

import datetime as dt
import itertools
import json
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from dqloom.sources.files import Place
from dqloom.sources.text_csv import content_digest, find_encoding, read_rows, with_record_ids

_ID = re.compile(r"ING_(\d{8})_(\d{3,})")
_ROWS, _MANIFEST = "rows", "manifest.json"


class LayoutError(ValueError):
    """A folder or file of a run that is not as it should be."""


def file_hash(path: str | Place) -> str:
    return Place(path).sha256()


def now_utc() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def _hash(spark: SparkSession, file: Place, digest: str) -> str:
    return file.sha256() if digest == "sha256" else content_digest(spark, str(file))


def _published(prepared: Place, day: str, facts: dict) -> dict:
    """Gives the prepared folder the day's next free id, together with a manifest that has it."""
    home = prepared.parent
    claims = home / ".claims"
    taken = [int(m[2]) for name in (*home.names(), *claims.names()) if (m := _ID.fullmatch(name)) and m[1] == day]
    for number in itertools.count(max(taken, default=0) + 1):
        run, rows = f"ING_{day}_{number:03d}", facts["row_count"]
        if not (claims / run).claim():
            continue
        width = max(6, len(str(rows)))
        ends = {k: f"{run}_ROW_{n:0{width}d}" if rows else None for k, n in (("first", 1), ("last", rows))}
        manifest = {"ingestion_id": run, **facts, "record_id": {"prefix": f"{run}_ROW_", "width": width, **ends}, "ingested_at": now_utc(), "profile": None}
        (prepared / _MANIFEST).write_text(json.dumps(manifest, indent=2, ensure_ascii=False))
        prepared.rename_to(home / run)
        return manifest
    raise AssertionError


def land(spark: SparkSession, source: str, dataset: str, raw_root: str, delimiter: str = ",", encoding: str | None = None, today: dt.date | None = None, digest: str = "sha256") -> dict:
    """Lands a file as a new batch; returns its manifest. digest: "sha256" of the bytes, which one stream computes, or "lines", by ranges in parallel."""
    origin = Place(source, spark)
    if not origin.is_file():
        raise LayoutError(f"no such file: {source}")
    prepared = Place(raw_root, spark) / dataset / f".landing-{uuid.uuid4().hex}"
    raw = prepared / origin.name
    try:
        seen = origin.copy_to(raw)
        if digest != "sha256":
            seen = _hash(spark, origin, digest)
        raw.protect()
        if _hash(spark, raw, digest) != seen:
            raise LayoutError(f"the copy of {source} differs from what was read")
        encoding = encoding or find_encoding(str(raw))
        cells = read_rows(spark, str(raw), delimiter, encoding)
        cells.write.parquet(str(prepared / _ROWS))
        n, columns = spark.read.parquet(str(prepared / _ROWS)).count(), cells.columns[1:]
        facts = {"dataset": dataset, "source_file": origin.full.removeprefix("file:"), "raw_file": raw.name, "rows": _ROWS, "digest": digest, "sha256": seen, "size_bytes": raw.size(), "encoding": encoding, "delimiter": delimiter, "columns": columns, "column_count": len(columns), "row_count": n}
        return _published(prepared, (today or dt.date.today()).strftime("%Y%m%d"), facts)
    finally:
        prepared.delete()


def latest_run(raw_root: str, dataset: str) -> str:
    found = [m for name in (Place(raw_root) / dataset).names() if (m := _ID.fullmatch(name))]
    if not found:
        raise LayoutError(f"nothing has been landed for {dataset} under {raw_root}")
    return max(found, key=lambda m: (m[1], int(m[2])))[0]


def read_manifest(raw_root: str, dataset: str, run: str | None = None) -> tuple[dict, Place]:
    """The manifest of a batch and its raw file, whose hash must be the recorded one."""
    folder = Place(raw_root) / dataset / (run or latest_run(raw_root, dataset))
    if not (folder / _MANIFEST).is_file():
        raise LayoutError(f"{folder} has no manifest")
    manifest = json.loads((folder / _MANIFEST).read_text())
    raw = folder / manifest["raw_file"]
    if not raw.is_file() or _hash(folder.spark, raw, manifest.get("digest", "sha256")) != manifest["sha256"]:
        raise LayoutError(f"{raw} is not the file that was landed")
    return manifest, raw


def read_batch(spark: SparkSession, raw_root: str, dataset: str, run: str | None = None, null_blank: bool = True) -> tuple[dict, DataFrame]:
    """A landed batch as text columns with row_no and record_id."""
    manifest, raw = read_manifest(raw_root, dataset, run)
    rows = spark.read.parquet(str(raw.parent / manifest["rows"]))
    if (n := rows.count()) != manifest["row_count"]:
        raise LayoutError(f"{raw.parent} has {n} rows, its manifest says {manifest['row_count']}")
    cell = lambda c: F.when(F.col(f"`{c}`") != "", F.col(f"`{c}`")).alias(c) if null_blank else F.col(f"`{c}`")
    rows = rows.select("row_no", *[cell(c) for c in manifest["columns"]])
    return manifest, with_record_ids(rows, manifest["record_id"]["prefix"], manifest["record_id"]["width"])


def register_profile(raw_root: str, dataset: str, run: str, path: str) -> None:
    file = Place(raw_root) / dataset / run / _MANIFEST
    file.write_text(json.dumps(json.loads(file.read_text()) | {"profile": path}, indent=2, ensure_ascii=False))


@dataclass(frozen=True)
class Run:
    """Tables and documents of one run."""

    spark: SparkSession
    root: str
    dataset: str
    run_id: str

    def path(self, table: str, round_: int | None = None) -> str:
        return f"{self.root}/{self.dataset}/{self.run_id}/{table}" + (f"/round={round_}" if round_ is not None else "")

    def write(self, df: DataFrame, table: str, round_: int | None = None, marker: str = "") -> DataFrame:
        """Writes a part of a step that the document ``marker`` publishes later; what a failed attempt has left there is replaced."""
        if marker and self.load(marker) is not None:
            raise LayoutError(f"{table} of {marker} in run {self.run_id} was published before")
        df.write.mode("overwrite" if marker else "errorifexists").parquet(self.path(table, round_))
        return self.spark.read.parquet(self.path(table, round_))

    def append(self, df: DataFrame, table: str, at: int, marker: str) -> None:
        """A part of a table that grows with each step; repeating the step replaces its part."""
        if self.load(marker) is not None:
            raise LayoutError(f"{table} of {marker} in run {self.run_id} was published before")
        df.write.mode("overwrite").parquet(f"{self.path(table)}/at={at}")

    def appended(self, table: str, markers: str) -> DataFrame | None:
        """All published parts of a table that grows; None if there is none."""
        df, steps = self.read(table), self.published(markers)
        return None if df is None or not steps else df.filter(F.col("at").isin(steps)).drop("at")

    def read(self, table: str, round_: int | None = None) -> DataFrame | None:
        """The table, or None if it was never written."""
        try:
            return self.spark.read.parquet(self.path(table, round_))
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER" in str(e):
                return None
            raise

    def need(self, table: str, round_: int | None = None) -> DataFrame:
        df = self.read(table, round_)
        if df is None:
            raise LayoutError(f"run {self.run_id} has no {table}" + (f" of round {round_}" if round_ else ""))
        return df

    @property
    def documents(self) -> Place:
        return Place(self.path("documents"), self.spark)

    def save(self, name: str, document: dict) -> None:
        (self.documents / f"{name}.json").write_text(json.dumps(document, indent=2, ensure_ascii=False, default=str))

    def load(self, name: str) -> dict | None:
        file = self.documents / f"{name}.json"
        return json.loads(file.read_text()) if file.is_file() else None

    def published(self, markers: str) -> list[int]:
        """Numbers of the steps whose documents are named <markers>-<number>."""
        return sorted(int(m[1]) for name in self.documents.names() if (m := re.fullmatch(rf"{markers}-(\d+)\.json", name)))

    def rounds(self) -> list[int]:
        return self.published("result")

    def clear(self) -> None:
        """Removes all but the profile; the markers first, so that a half-cleared run counts as never validated."""
        for name in self.documents.names():
            if name != "profile.json":
                (self.documents / name).delete()
        home = self.documents.parent
        for name in home.names():
            if name != "documents":
                (home / name).delete()


def list_runs(root: str, dataset: str) -> list[str]:
    base = Place(root) / dataset
    return [name for name in base.names() if (base / name / "documents" / "result-1.json").is_file()]


def _reading(read, empty):
    """read(), or empty() where no file is."""
    try:
        return read()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER" in str(e):
            return empty()
        raise


def _of_path(pattern: str, group: int) -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, group)


def all_documents(spark: SparkSession, root: str, dataset: str, markers: str, schema: str) -> DataFrame:
    """The published documents <markers>-<number> of all runs of a dataset, one row each; run_id is the folder's name."""
    read = lambda: spark.read.schema(schema).json(f"{root}/{dataset}/*/documents/{markers}-*.json", multiLine=True)
    named = lambda df: df.withColumn("run_id", _of_path(rf"/([^/]+)/documents/{markers}-\d+\.json$", 1))
    return _reading(lambda: named(read()), lambda: spark.createDataFrame([], schema))


def all_parts(spark: SparkSession, root: str, dataset: str, table: str, key: str, schema: str, published: DataFrame) -> DataFrame:
    """A table of all runs with its columns of schema, run_id and at, the number of the part (key=number). published: run_id and at of the parts that count."""
    columns = StructType.fromDDL(schema)
    some = lambda df: df.select(*[F.col(f.name).cast(f.dataType) for f in columns], _of_path(rf"/([^/]+)/{table}/{key}=\d+/[^/]*$", 1).alias("run_id"), _of_path(rf"/{table}/{key}=(\d+)/[^/]*$", 1).cast("int").alias("at"))
    rows = _reading(lambda: some(spark.read.parquet(f"{root}/{dataset}/*/{table}/{key}=*")), lambda: spark.createDataFrame([], schema + ", run_id string, at int"))
    return rows.join(published, ["run_id", "at"], "left_semi")
