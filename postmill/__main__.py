"""Command line: ``python -m postmill run LANDING ROOT`` or ``python -m postmill search ROOT TEXT``."""

import argparse

from postmill import settings
from postmill.functions.vectors import hashing_encoder, sentence_encoder
from postmill.operators.search import presented, search_text
from postmill.plans.jobs import run_all
from postmill.schema import PAGE_DDL
from postmill.session import get_spark_session
from postmill.sources.tables import KeyedTable, read_json_lines


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="postmill")
    parser.add_argument("--model", help=f"a sentence-transformers model such as {settings.MODEL_NAME}")
    parser.add_argument("--bits", type=int, help="the vectors are stored in 2**BITS buckets, for approximate search")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="landed listing pages to bronze, silver, gold and vectors")
    run.add_argument("landing")
    run.add_argument("root")
    find = commands.add_parser("search", help="search the vectors below a root")
    find.add_argument("root")
    find.add_argument("text")
    find.add_argument("--results", type=int, default=settings.SEARCH_K)
    find.add_argument("--group", default=settings.ALL_GROUPS)
    find.add_argument("--radius", type=int, help="with --bits: buckets at most so many sides away are read; by default enough for a recall of 0.9")
    options = parser.parse_args(argv)

    spark = get_spark_session()
    encoder = sentence_encoder(options.model) if options.model else hashing_encoder()
    if options.command == "run":
        run_all(spark, read_json_lines(spark, options.landing, PAGE_DDL), options.root, encoder, bits=options.bits, encoder_name=options.model or "")
    else:
        records = KeyedTable(spark, f"{options.root}/vectors")
        group = None if options.group == settings.ALL_GROUPS else options.group
        found = search_text(records, options.text, options.results, group, encoder, options.bits, options.radius)
        presented(found).show(options.results, truncate=False)


if __name__ == "__main__":
    main()
