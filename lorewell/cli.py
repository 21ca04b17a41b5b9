"""Command line: the three queries, the line sharders and the text of word vectors.

    python -m lorewell.cli --task cat --page-dump 'page*.sql.gz' --output /tmp/out
    python -m lorewell.cli --task shard --input 'pages*.txt' --output /tmp/out/pages-{}.gz --shard-chars 500000000
    python -m lorewell.cli --task vectors --input vectors.parquet --output /tmp/out/vectors
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .operators.links import leaves, link_metrics
from .operators.ranking import repeated, top_parents
from .plans.ancestors import gather_entity_ancestors
from .plans.leaf_index import create_category_index
from .sinks.files import shard_lines, write_metrics, write_records, write_sized_shards, write_vectors
from .sources import headers, lines, records, samples

TASKS = ("cat", "gather", "count_children", "shard", "vectors")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--task", choices=TASKS, default="cat")
    for name in ("categorylinks", "page", "wikidata", "qrank"):
        p.add_argument(f"--{name}-dump", help="files by a pattern, packed or not; a small sample if it isn't given")
    p.add_argument("--max-readlines", type=int, help="lines of each dump, or of the input")
    p.add_argument("--partitions", type=int, help="tasks that read lines are dealt to; by default as many as a shuffle has, for packed files")
    p.add_argument("--verify-headers", action=argparse.BooleanOptionalAction, default=True)
    p.add_argument("--mode", choices=("drop", "fail"), default="drop", help="what malformed records do")
    p.add_argument("--output", default="/tmp/lorewell/")
    p.add_argument("--format", choices=("parquet", "json", "text"), default="parquet")
    p.add_argument("--iters", type=int, default=10)
    p.add_argument("--leaves", type=int, default=10_000)
    p.add_argument("--top", type=int, default=10_000)
    p.add_argument("--prune-empty-children", action="store_true")
    p.add_argument("--intermediates", help="for cat: a folder for the links, as text")
    p.add_argument("--input", help="for shard: files by a pattern; for vectors: a table with name, is_entity, doc_count, vector")
    p.add_argument("--num-shards", type=int, default=24)
    p.add_argument("--shard-chars", type=int, help="for shard: files of so many characters, in the input's order, named by --output, whose {} is a number")
    return p.parse_args(argv)


def inputs(spark: SparkSession, args: argparse.Namespace, require_title: bool) -> tuple[dict[str, DataFrame], dict[str, Observation]]:
    """Links, pages, entities and ranks, from dumps or samples, and the counts of records of the dumps."""
    counts: dict[str, Observation] = {}

    def read(name: str, pattern: str | None, header: list[str] | None, parse, sample, **more) -> DataFrame:
        if not pattern:
            return sample(spark)
        counts[name] = Observation(name)
        found = lines.read_lines(spark, pattern, header if args.verify_headers else None, args.max_readlines, args.partitions)
        return parse(found, mode=args.mode, counts=counts[name], **more)

    tables = {
        "links": read("links", args.categorylinks_dump, headers.dump_header("categorylinks"), records.category_links, samples.links),
        "pages": read("pages", args.page_dump, headers.dump_header("page"), records.pages, samples.pages),
        "entities": read("entities", args.wikidata_dump, None, records.entities, samples.entities, require_title=require_title),
        "ranks": read("ranks", args.qrank_dump, headers.RANK_HEADER, records.ranks, samples.ranks),
    }
    return tables, counts


def shard(spark: SparkSession, args: argparse.Namespace) -> None:
    found = lines.read_lines(spark, args.input, None, args.max_readlines, 0 if args.shard_chars else args.partitions)
    if args.shard_chars:
        # The order of the input: files by name, then the place in the file.
        placed = found.select("value", F.input_file_name().alias("file"), F.input_file_block_start().alias("block"), F.monotonically_increasing_id().alias("line"))
        write_sized_shards(placed, ["file", "block", "line"], args.output, args.shard_chars)
    else:
        shard_lines(found, args.output.rstrip("/"), args.num_shards)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    out = args.output.rstrip("/")
    save = lambda df, name: write_records(df, f"{out}/{name}", args.format)
    if args.task == "shard":
        return shard(spark, args)
    if args.task == "vectors":
        return write_vectors(spark.read.parquet(args.input), out)
    world, counts = inputs(spark, args, require_title=args.task == "cat")
    metrics: dict[str, DataFrame] = {}
    used = ["entities"]
    if args.task == "cat":
        index = create_category_index(**world, iters=args.iters, n=args.leaves, prune_empty_children=args.prune_empty_children, intermediates=args.intermediates)
        for name, nodes in index._asdict().items():
            save(nodes, f"{name}_nodes")
        metrics = link_metrics(world["links"], world["pages"], world["entities"]) | {"repeated_scores": repeated(leaves(world["ranks"]), "leaf_id")}
        used = list(world)
    elif args.task == "gather":
        save(gather_entity_ancestors(world["entities"], args.iters), "gathered_ancestors")
        metrics = {"repeated_nodes": repeated(world["entities"], "qid")}
    else:
        save(top_parents(world["entities"], args.top), "top_parents")
        metrics = {"entities": world["entities"].agg(F.count(F.lit(1)).alias("entities"), F.count_if(F.size("claims") > 0).alias("with_claims"))}
    write_metrics(f"{out}/metrics", metrics, {name: counts[name].get for name in used if name in counts})


def main(argv: list[str] | None = None) -> None:
    run(SparkSession.builder.appName("lorewell").getOrCreate(), arguments(argv))


if __name__ == "__main__":
    main()
