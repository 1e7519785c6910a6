"""Sources: typed JSON and JSON lines, configuration with defaults, sheets, binary documents with a pluggable extractor."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rules as R

CONFIG_DEFAULTS = {"ocr_pages": [], "ocr_sections": [], "table_sections": [], "skip_sections": [], "compound_material_rules": [], "section_overrides": {}}


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON array (or object) of typed rows."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank ones are skipped by the reader."""
    return spark.read.schema(schema).json(path)


def read_config(path: str | None) -> dict:
    """A manual configuration; without a path or file, the defaults."""
    if not path or not os.path.exists(path):
        return dict(CONFIG_DEFAULTS)
    with open(path, encoding="utf-8") as f:
        return CONFIG_DEFAULTS | json.load(f)


def overrides(spark: SparkSession, config: dict) -> DataFrame:
    schema = "section_path string, expected_pages array<int>, content_type string, reuse_method string, long_term boolean, use_ocr boolean, parse_table boolean"
    rows = [(p, o.get("expected_pages"), o.get("content_type"), o.get("reuse_method"), o.get("enter_long_term_library"), o.get("use_ocr"), o.get("parse_table")) for p, o in (config.get("section_overrides") or {}).items()]
    return spark.createDataFrame(rows, schema)


def sheet_cells(spark: SparkSession, path: str) -> DataFrame:
    """All cells of a workbook: sheet, row, col, value (needs an Excel reader for pandas; sheets are small)."""
    sheets = pd.read_excel(path, sheet_name=None, header=None)
    rows = [(str(s), i, j, "" if pd.isna(v) else str(v)) for s, df in sheets.items() for i, r in enumerate(df.itertuples(index=False)) for j, v in enumerate(r)]
    return spark.createDataFrame(rows, "sheet string, row int, col int, value string")


def sheet_rows(cells: DataFrame) -> DataFrame:
    """Cells under the detected header row as rows of canonical columns: sheet, row_ord, file_type, ...

    The file type is the first cell of a sheet, or its name where that is blank or a running number."""
    head = R.header_row(cells).select("sheet", F.col("row").alias("head"))
    names = cells.join(head, "sheet").filter("row = head").select("sheet", "head", "col", F.col("value").alias("name"))
    first = cells.filter("row = 0 and col = 0").select("sheet", F.when(F.trim("value").isin("", "序号"), F.col("sheet")).otherwise(F.trim("value")).alias("sheet_type"))
    aliases = names.sparkSession.createDataFrame([(a, c, n) for c, xs in R.COLUMN_ALIASES.items() for n, a in enumerate(xs)], "alias string, canonical string, n int")
    from ..functions.text import header_name

    known = names.join(F.broadcast(aliases), header_name(F.col("name")) == header_name(F.col("alias"))).groupBy("sheet", "head", "canonical").agg(F.min_by("col", "n").alias("col"))
    body = cells.join(known, ["sheet", "col"]).filter("row > head").withColumn("row_ord", F.col("row") - F.col("head"))
    wide = body.groupBy("sheet", "row_ord").pivot("canonical", list(R.COLUMN_ALIASES)).agg(F.first("value")).na.fill("")
    filled = wide.filter(F.concat_ws("", *R.COLUMN_ALIASES) != "").join(first, "sheet", "left")
    return filled.withColumn("file_type", F.coalesce(F.nullif(F.col("file_type"), F.lit("")), "sheet_type")).drop("sheet_type")


def _plain(rows: list[dict], columns: list[str]) -> pd.DataFrame:
    """Rows as a frame of Python objects, None where a value is missing."""
    return pd.DataFrame([[r.get(c) for c in columns] for r in rows], columns=columns, dtype=object)


def read_documents(spark: SparkSession, path: str, extract: Callable[[bytes], Iterator[dict]], schema: str) -> DataFrame:
    """Binary files through an extractor that yields rows for one file (PDF libraries are plug-ins); a failing file gives an error row."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in schema.split(", ")]
        for pdf in batches:
            for name, data in zip(pdf["path"], pdf["content"]):
                try:
                    rows = [{"path": name, "error": None, **r} for r in extract(data)]
                except Exception as e:  # noqa: BLE001  a broken file is data, not a reason to stop
                    rows = [{"path": name, "error": str(e)}]
                yield _plain(rows, ["path", "error", *columns])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(work, f"path string, error string, {schema}")


def call_pages(pages: DataFrame, client: Callable[[dict], dict] | list, schema: str, retries: int = 1, workers: int | None = None) -> DataFrame:
    """Rows through an injected client (OCR, vision): ``retries`` more calls for empty answers, failures as an ``error`` column.

    Of a list of clients the first that answers wins, each with its own retries."""
    columns, names = [c.split()[0] for c in schema.split(", ")], pages.columns
    calls = [c for c in (client if isinstance(client, list) else [client]) for _ in range(retries + 1)]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                got, error = None, None
                for call in calls:
                    try:
                        got, error = call(row), None
                    except Exception as e:  # noqa: BLE001
                        error = str(e)
                    if got:
                        break
                out.append(row | {"error": error if got else error or "empty"} | (got or {}))
            yield _plain(out, [*names, "error", *columns])

    spread = pages.repartition(workers) if workers else pages
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema)
    return spread.mapInPandas(work, f"{kept}, error string, {schema}")


def material_dirs(spark: SparkSession, root: str) -> DataFrame:
    """Folders with material files, not the four item folders: run_name, dir, files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    parts = F.regexp_extract("path", r"^(.*)/([^/]+)$", 1), F.regexp_extract("path", r"^(.*)/([^/]+)$", 2)
    kept = files.select(parts[0].alias("dir"), parts[1].alias("file")).filter(F.col("file").isin("material.md", "ordered_material.json", "material_meta.json")).filter(~F.col("dir").rlike(r"/(texts|tables|images|submaterials)$"))
    return kept.groupBy("dir").agg(F.sort_array(F.collect_set("file")).alias("files")).withColumn("run_name", F.regexp_extract("dir", r"([^/]+)/modules(?:/|$)", 1))
