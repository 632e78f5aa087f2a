"""python -m millrace crawl --year Y [--limit N] | enrich | serve --year Y [--port P]   [--base DIR] --provider COMMAND... [--search-tools ARGS...]"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from millrace.operators import crawl, enrich
from millrace.operators.review import load_review
from millrace.schemas import RECORD
from millrace.server import make_server
from millrace.sources.provider import NAMING_TIMEOUT, CommandLine
from millrace.sources.seed import load_seed
from millrace.sources.sitemap import read_sitemaps
from millrace.sources.tables import read_store
from millrace.sources.web import Fetcher


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="millrace")
    p.add_argument("job", choices=("crawl", "enrich", "serve"))
    p.add_argument("--year", type=int)
    p.add_argument("--limit", type=int)
    p.add_argument("--port", type=int, default=8765)
    p.add_argument("--base", default="output")
    p.add_argument("--provider", nargs="+", required=True, help="command that takes a prompt as its last argument and prints JSON with a result")
    p.add_argument("--search-tools", nargs="*", default=[], help="arguments that let the command search the web, put before the prompt of a search")
    a = p.parse_args(argv)
    if a.job != "enrich" and a.year is None:
        p.error(f"{a.job} needs --year")
    return a


def command(a: argparse.Namespace, job: str) -> list[str]:
    """The command line of a job that the server starts."""
    year = ["--year", str(a.year)] if job == "crawl" else []
    tools = ["--search-tools", *a.search_tools] if a.search_tools else []
    return [sys.executable, "-m", "millrace", job, *year, "--base", a.base, *tools, "--provider", *a.provider]


def serve(spark: SparkSession, a: argparse.Namespace):
    """The review server of a year; a missing or faulty seed stops it at once."""
    seed = load_seed(spark, a.base, a.year)
    slugs = {r[0] for r in crawl.slugged(seed).select("slug").distinct().collect()}  # a list that people keep

    def data() -> dict:
        tables = load_review(spark, a.base, a.year, seed)
        return {name: [r.asDict() for r in t.orderBy("pos").drop("pos").collect()] for name, t in tables.items()}

    return make_server(data, lambda: slugs, lambda job: command(a, job), lambda slug, again: crawl.clear_cache(spark, a.base, a.year, slug, again), a.port)


def main(argv: list[str] | None = None) -> None:
    a = arguments(argv)
    spark = SparkSession.builder.appName(f"millrace-{a.job}").getOrCreate()
    provider = CommandLine(tuple(a.provider))
    if a.job == "crawl":
        print(crawl.run(spark, a.base, a.year, provider, sitemaps=read_sitemaps(spark, Fetcher().text), limit=a.limit, search=provider.for_search(*a.search_tools)))
    elif a.job == "enrich":
        print(enrich.enrich(spark, a.base, read_store(spark, os.path.join(a.base, "records"), RECORD), CommandLine(tuple(a.provider), NAMING_TIMEOUT)))
    else:
        server = serve(spark, a)
        print(f"http://127.0.0.1:{server.server_address[1]}/", flush=True)
        server.serve_forever()


if __name__ == "__main__":
    main()
