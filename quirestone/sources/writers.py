"""Sinks: JSON, JSON lines, CSV with sorted columns, package trees and packs."""

from __future__ import annotations

import io
import json
import os
import zipfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with columns in order of their names, nested ones as JSON."""
    cols = [F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in sorted(df.dtypes)]
    df.select(*cols).write.mode("overwrite").option("header", True).csv(path)


def write_packages(materials: DataFrame, items: DataFrame, root: str) -> DataFrame:
    """A folder for each material with its Markdown, items and meta, written by tasks; the manifest of what was written."""
    rows = items.groupBy("doc_id", "scope_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct("n", "item_type", "item_id", "page_no", "text")))).alias("items"))
    both = materials.join(rows, ["doc_id", "scope_id"], "left")

    def work(batches):
        for pdf in batches:
            for r in pdf.to_dict("records"):
                folder = safe_join(root, str(r["doc_id"]), str(r["scope_id"]))
                os.makedirs(folder, exist_ok=True)
                meta = {"doc_id": r["doc_id"], "scope_id": str(r["scope_id"])}
                for name, text in (("material.md", r["markdown"] or ""), ("ordered_material.json", r["items"] or "[]"), ("material_meta.json", json.dumps(meta))):
                    part = os.path.join(folder, f".{name}")
                    with open(part, "w", encoding="utf-8") as f:
                        f.write(text)
                    os.replace(part, os.path.join(folder, name))  # a repeated task writes the same file
            yield pdf[["doc_id", "scope_id"]]

    return both.select("doc_id", F.col("scope_id").cast("string").alias("scope_id"), "markdown", "items").mapInPandas(work, "doc_id long, scope_id string")


KINDS = {"markdown": (".md",), "json": (".json",), "images": (".png", ".jpg", ".jpeg"), "csv": (".csv",)}


def write_files(files: DataFrame, root: str) -> DataFrame:
    """Files ``(path, content)`` below ``root``, written by tasks; the manifest: path, bytes. Null contents are skipped; a path that leaves ``root`` fails."""
    def work(batches):
        for pdf in batches:
            kept = pdf[pdf["content"].notna()]
            for name, data in zip(kept["path"], kept["content"]):
                full = safe_join(root, name)
                os.makedirs(os.path.dirname(full), exist_ok=True)
                part = f"{full}.part"
                with open(part, "wb") as f:
                    f.write(data)
                os.replace(part, full)
            yield kept.assign(bytes=[len(x) for x in kept["content"]])[["path", "bytes"]]

    return files.select("path", "content").mapInPandas(work, "path string, bytes long")


def write_trace(stages: dict[str, DataFrame], path: str) -> None:
    """What each stage of region detection gave, as JSON lines in a folder for each stage."""
    for name, df in stages.items():
        df.write.mode("overwrite").json(os.path.join(path, f"stage={name}"))


def light_pack(root: str, kinds: tuple[str, ...] = ("markdown", "json"), target: str | None = None) -> tuple[bytes, dict[str, int]]:
    """A zip of the chosen kinds of files, in sorted order, and the count of each kind; into the file ``target``, if given, a file at a time."""
    counts, data = dict.fromkeys(KINDS, 0), target or io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(root)):
            for n in sorted(names):
                kind = next((k for k in kinds if n.endswith(KINDS[k])), None)
                if kind and os.path.join(folder, n) != target:
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), root))
                    counts[kind] += 1
    return b"" if target else data.getvalue(), counts


def safe_join(root: str, *parts: str) -> str:
    """A path below ``root``; ValueError for one that leaves it."""
    full = os.path.realpath(os.path.join(root, *parts))
    if full != os.path.realpath(root) and not full.startswith(os.path.realpath(root) + os.sep):
        raise ValueError("path leaves its root")
    return full
