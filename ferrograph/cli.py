"""Command line: ``query`` and ``benchmark`` of classes and keywords over a published record file, and ``extract``, which publishes one from recorded inputs."""

from __future__ import annotations

import argparse
import json
import os
import sys
import time
from dataclasses import asdict

from pyspark.sql import SparkSession

from .operators.graph import GraphError, build_graph, validated
from .operators.query import RESULT, ValueNotFound, query_class, query_keyword
from .plans import benchmark
from .plans.extraction import ExtractionError, run_extraction
from .sources.admit import IngestError, load_dataset
from .sources.config import Config, ConfigError


class _Usage(Exception):
    pass


class _Parser(argparse.ArgumentParser):
    def error(self, message):
        raise _Usage(message)


def _name(value: str) -> str:
    if not value.strip():
        raise argparse.ArgumentTypeError("a name must not be blank")
    return value


def parser() -> argparse.ArgumentParser:
    top = _Parser(prog="ferrograph")
    commands = top.add_subparsers(dest="command", required=True, parser_class=_Parser)
    for command in ("query", "benchmark"):
        families = commands.add_parser(command).add_subparsers(dest="family", required=True, parser_class=_Parser)
        for family in ("class", "keyword"):
            p = families.add_parser(family)
            p.add_argument("--input", required=True)
            p.add_argument("--name", required=True, type=_name)
            p.add_argument("--format", choices=("text", "json"), default="text")
            if command == "benchmark":
                p.add_argument("--warmup", type=int, default=1_000)
                p.add_argument("--iterations", type=int, default=10_000)
                p.add_argument("--max-p95-us", type=float)
    p = commands.add_parser("extract")
    for name in ("members", "payloads", "pages", "output"):
        p.add_argument(f"--{name}", required=True)
    for name in ("api", "guide-root", "contact", "root-category"):  # else from the environment
        p.add_argument(f"--{name}")
    p.add_argument("--nation", action="append", default=[])
    p.add_argument("--format", choices=("text", "json"), default="text")
    return top


def _extract(a, spark: SparkSession, as_json: bool) -> int:
    """Recorded tables are Parquet; 1 if the run fails for a reason that can be expected."""
    try:
        config = Config.of({"api": a.api, "guide_root": a.guide_root, "contact": a.contact, "root_category": a.root_category, "nations": tuple(a.nation)}, os.environ)
        summary = run_extraction(config, spark.read.parquet(a.members), spark.read.parquet(a.payloads), spark.read.parquet(a.pages), a.output)
    except ConfigError as e:
        return _error(as_json, e.code, str(e), 1)
    except ExtractionError as e:
        return _error(as_json, "extraction", str(e), e.exit_code, codes=e.codes)
    except IngestError as e:
        return _error(as_json, e.code, str(e), 1, **e.context)
    told = asdict(summary)
    print(json.dumps(told, ensure_ascii=False) if as_json else "\n".join(f"{k}: {v}" for k, v in told.items()))
    return 0


def _error(as_json: bool, code: str, message: str, exit_code: int, **context) -> int:
    if as_json:
        print(json.dumps({"error": {"code": code, "message": message, **context}}, ensure_ascii=False, default=str), file=sys.stderr)
    else:
        print(f"error: {message}", file=sys.stderr)
    return exit_code


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """0 done, 2 usage, 3 input, 4 not found, 5 budget, 6 invariant or collision, 7 gate; data goes to stdout, errors to stderr."""
    args = sys.argv[1:] if args is None else args
    as_json = "--format=json" in args or any(a == "--format" and b == "json" for a, b in zip(args, args[1:], strict=False))
    try:
        a = parser().parse_args(args)
    except _Usage as e:
        return _error(as_json, "usage", str(e), 2)
    spark = spark or SparkSession.builder.getOrCreate()
    as_json = a.format == "json"
    if a.command == "extract":
        return _extract(a, spark, as_json)
    try:
        t0 = time.perf_counter_ns()
        data = load_dataset(spark, a.input)
        if not data.is_production_success:
            raise IngestError("semantic_validation", "; ".join(data.warnings))
        t1 = time.perf_counter_ns()
        graph = validated(build_graph(data.records))
        t2 = time.perf_counter_ns()
        ask = query_class if a.family == "class" else query_keyword
        plan = ask(graph, a.name)
        if a.command == "benchmark":
            report = benchmark.run(a.family, a.name, plan.collect, a.warmup, a.iterations, a.max_p95_us)
            sys.stdout.write(report.to_json() if as_json else report.to_text())
            return report.exit_code
        rows = [r.asDict(recursive=True) for r in plan.select(*RESULT).collect()]
        t3 = time.perf_counter_ns()
        timing = {k: -(-(b - a_) // 1000) for k, a_, b in (("load_us", t0, t1), ("build_us", t1, t2), ("query_us", t2, t3))}
        if as_json:
            print(json.dumps({"family": a.family, "name": a.name, "rows": rows, "timing": timing}, ensure_ascii=False))
        else:
            for r in rows:
                print(f"{r['display_name']} ({r['name']}), {r['nation']}, tier {r['tier']}" + "".join(f"\n  - {s}" for s in r["matched_strategies"]))
            print(f"{len(rows)} rows")
        return 0
    except IngestError as e:
        return _error(as_json, e.code, str(e), e.exit_code, **e.context)
    except ValueNotFound as e:
        return _error(as_json, e.code, str(e), e.exit_code, kind=e.kind, value=e.value, normalized_value=e.normalized, available=e.available)
    except GraphError as e:
        return _error(as_json, e.code, str(e), e.exit_code, **e.context)


if __name__ == "__main__":
    sys.exit(main())
