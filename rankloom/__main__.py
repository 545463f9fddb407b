"""Command line: python -m rankloom JOB ...; providers are given as module:factory."""

from __future__ import annotations

import argparse
import importlib
import json
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from rankloom.operators import clients
from rankloom.plans import jobs
from rankloom.plans.progress import watched
from rankloom.sources import tables
from rankloom.sources.versions import VersionedTable


def provider(spec: str, kind: Callable = clients.embedder) -> Callable:
    """The factory that module:name means; http:PREFIX is a service that the environment names (see operators/clients)."""
    module, _, name = spec.partition(":")
    if module == "http":
        return kind(name)
    return getattr(importlib.import_module(module), name)


def _rows(spark: SparkSession, path: str):
    """A dataset with a row_index: its own, or the hash of its question and source."""
    own = tables.read_dataset(spark, path)
    return own.withColumn("row_index", F.col("row_index").cast("long") if "row_index" in own.columns else F.xxhash64("user_input", "source_files_with_pages"))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    top = argparse.ArgumentParser(prog="rankloom", description=__doc__)
    sub = top.add_subparsers(dest="job", required=True)

    def job(name: str, *flags: str, **more) -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        for f in flags:
            p.add_argument(f"--{f}", required=True)
        for f, default in more.items():
            p.add_argument(f"--{f.replace('_', '-')}", default=default, type=type(default) if default is not None else str)
        return p

    job("ingest", "folder", "pages", kinds="").add_argument("--reprocess", action="store_true")
    job("embed", "pages", "vectors", "embedder")
    job("profile", "pages", "profiles", "generator")
    job("generate", "pages", "generator", "out", n=100, seed=42)
    job("mine", "dataset", "pages", "vectors", "embedder", "judge", "out")
    job("validate", "dataset", "pages", "judge", "out")
    job("evaluate", "dataset", "pages", "vectors", "embedder", "out")
    job("compare", metric="mrr", n=10_000).add_argument("files", nargs="+")
    args = top.parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"rankloom-{args.job}").getOrCreate()
    at = lambda name: VersionedTable(spark, getattr(args, name))
    if args.job == "ingest":
        rejected = jobs.ingest(spark, args.folder, at("pages"), tuple(k for k in args.kinds.split(",") if k), args.reprocess)
        print(json.dumps({"pages": at("pages").read().count(), "rejected": rejected.count()}))
    elif args.job == "embed":
        with watched(spark, "embed"):
            print(json.dumps({"vectors": jobs.embed(at("pages").read(), at("vectors"), provider(args.embedder)).count()}))
    elif args.job == "profile":
        with watched(spark, "profile"):
            print(json.dumps({"profiles": jobs.profile(at("pages").read(), at("profiles"), provider(args.generator, clients.generator)).count()}))
    elif args.job == "generate":
        tables.write_dataset(jobs.single_hop(at("pages").read(), provider(args.generator, clients.generator), args.n, seed=args.seed), args.out, ("parquet",))
    elif args.job == "validate":
        verdicts = jobs.materialize(jobs.validate(_rows(spark, args.dataset), at("pages").read(), provider(args.judge, clients.generator)), "verdicts")
        tables.write_dataset(jobs.keep_passing(_rows(spark, args.dataset), verdicts), args.out, ("parquet",))
        jobs.quality.validation_report(verdicts, "synthesizer_name").write.mode("overwrite").json(f"{args.out}.report")
    elif args.job == "compare":
        for row in jobs.compare(spark, args.files, args.metric, args.n).toLocalIterator():
            print(json.dumps(row.asDict()))
    else:
        make = provider(args.embedder)
        rows = jobs.materialize(_rows(spark, args.dataset), "dataset")
        queries = jobs.materialize(jobs.embed_queries(rows, make), "queries")
        pages = at("pages").read()
        corpus = jobs.materialize(jobs.corpus(pages, at("vectors").read(), make().model), "corpus")
        if args.job == "mine":
            tables.write_dataset(jobs.mine(rows, queries, pages, corpus.select("id", "vec"), provider(args.judge, clients.generator)), args.out, ("parquet",))
        else:
            each, summary = jobs.evaluate(rows, queries, corpus)
            tables.write_evaluation(summary, each, args.out)


if __name__ == "__main__":
    main()
