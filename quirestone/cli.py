"""``python -m quirestone.cli <command>``: one command for each step, over Parquet or JSON lines folders."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from .operators import candidates, matching, packaging, retrieval, rules, sections
from .sources import readers, writers


def flag(text: str) -> bool:
    return text.strip().lower() in ("1", "true", "yes", "y", "是")


def elapsed(seconds: float) -> str:
    minutes, rest = divmod(int(seconds), 60)
    return f"{minutes}m {rest}s" if minutes else f"{rest}s"


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path) if path.endswith((".json", ".jsonl")) else spark.read.parquet(path)


def save(df: DataFrame, path: str) -> None:
    if path.endswith(".csv"):
        writers.write_csv(df, path)
    elif path.endswith((".json", ".jsonl")):
        writers.write_json_lines(df, path)
    else:
        df.write.mode("overwrite").parquet(path)


def load_rules(s, a):
    save(rules.rules(readers.sheet_rows(readers.sheet_cells(s, a.input[0]))), a.out)


def build_plan(s, a):
    c = readers.read_config(a.config)
    save(rules.plan(load(s, a.input[0]), readers.overrides(s, c), a.file_type, c["ocr_pages"], c["ocr_sections"], c["table_sections"], c["skip_sections"]), a.out)


def blocks(s, a):
    save(sections.blocks_from_text(load(s, a.input[0])), a.out)


def merge_ocr(s, a):
    save(sections.add_ocr(load(s, a.input[0]), load(s, a.input[1])), a.out)


def build_sections(s, a):
    save(sections.sections(load(s, a.input[0]), load(s, a.input[1])), a.out)


def match_sections(s, a):
    save(matching.match(*(load(s, p) for p in a.input[:3])), a.out)


def extract_candidates(s, a):
    save(candidates.extract(*(load(s, p) for p in a.input[:7])), a.out)


def package_materials(s, a):
    items = packaging.material_items(*(load(s, p) for p in a.input[:4]))
    save(packaging.material_markdown(items), a.out)


def build_chunks(s, a):
    save(retrieval.chunks(load(s, a.input[0])), a.out)


def search(s, a):
    for r in retrieval.search(load(s, a.input[0]), a.query, a.k, a.method).collect():
        print(json.dumps(r.asDict(), ensure_ascii=False))


def eval_retrieval(s, a):
    save(retrieval.report(retrieval.evaluate(load(s, a.input[0]), load(s, a.input[1]))), a.out)


COMMANDS = {
    "load-rules": load_rules, "build-plan": build_plan, "blocks": blocks, "merge-ocr": merge_ocr, "build-sections": build_sections, "match-sections": match_sections,
    "extract-candidates": extract_candidates, "package-materials": package_materials, "build-chunks": build_chunks, "search": search, "eval-retrieval": eval_retrieval,
}


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="quirestone")
    p.add_argument("command", choices=sorted(COMMANDS))
    p.add_argument("--input", nargs="+", required=True)
    p.add_argument("--out")
    p.add_argument("--config")
    p.add_argument("--file-type")
    p.add_argument("--query", default="")
    p.add_argument("-k", type=int, default=5)
    p.add_argument("--method", default="bm25")
    a = p.parse_args(argv)
    COMMANDS[a.command](SparkSession.builder.appName("quirestone").getOrCreate(), a)


if __name__ == "__main__":
    main()
