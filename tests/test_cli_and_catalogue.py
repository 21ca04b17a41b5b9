import gzip
import json
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from lorewell import cli
from lorewell.plans import catalogue

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.parametrize("task", ["cat", "gather", "count_children"])
def test_tasks_on_samples(spark, tmp_path, task):
    cli.run(spark, cli.arguments(["--task", task, "--output", str(tmp_path), "--intermediates", f"{tmp_path}/between"]))
    found = {"cat": "done_nodes", "gather": "gathered_ancestors", "count_children": "top_parents"}[task]
    rows = spark.read.parquet(f"{tmp_path}/{found}").collect()
    assert len(rows) == {"cat": 4, "gather": 10, "count_children": 4}[task]
    metrics = json.loads(spark.read.text(f"{tmp_path}/metrics").first()[0])
    if task == "cat":
        assert set(metrics) == {"titles", "title_to_page", "page_to_category", "category_to_parent", "repeated_scores"}
        assert metrics["titles"] == [{"categories": 4, "non_categories": 6}]
        assert spark.read.text(f"{tmp_path}/between/leaf_links").count() == 6


def test_counts_of_records(spark, tmp_path):
    (tmp_path / "r.csv").write_text("Entity,QRank\nQ101,7\nQ102\nQ103,x\n")
    cli.run(spark, cli.arguments(["--qrank-dump", f"{tmp_path}/r.csv", "--output", f"{tmp_path}/out"]))
    assert json.loads(spark.read.text(f"{tmp_path}/out/metrics").first()[0])["records"] == {"ranks": {"records": 3, "malformed": 2}}
    with pytest.raises(Exception, match="malformed"):
        cli.run(spark, cli.arguments(["--qrank-dump", f"{tmp_path}/r.csv", "--output", f"{tmp_path}/o2", "--mode", "fail"]))


def test_sharding(spark, tmp_path):
    (tmp_path / "in.txt").write_text("a\nb\nc\n")
    cli.run(spark, cli.arguments(["--task", "shard", "--input", f"{tmp_path}/in.txt", "--output", f"{tmp_path}/out", "--num-shards", "2"]))
    assert spark.read.text(f"{tmp_path}/out").count() == 3


def test_sharding_by_size(spark, tmp_path):
    for k in (1, 2):
        (tmp_path / f"in-{k}.txt").write_text("".join(f"{k}{j:03d}\n" for j in range(50)))
    cli.run(spark, cli.arguments(["--task", "shard", "--input", f"{tmp_path}/in-*.txt", "--output", f"{tmp_path}/out/s-{{}}.gz", "--shard-chars", "100"]))
    assert sorted(p.name for p in (tmp_path / "out").glob("*.gz")) == [f"s-{k:05d}.gz" for k in range(4)]
    with gzip.open(tmp_path / "out/s-00002.gz", "rt") as f:
        assert f.read().split() == [f"2{j:03d}" for j in range(25)]
    cli.run(spark, cli.arguments(["--task", "shard", "--input", f"{tmp_path}/in-1.txt", "--output", f"{tmp_path}/few/s.gz", "--shard-chars", "100", "--max-readlines", "30"]))
    assert sorted(p.name for p in (tmp_path / "few").glob("*.gz")) == ["s-00000.gz", "s-00001.gz"]


def test_vectors(spark, tmp_path):
    spark.createDataFrame([("the", False, 9, [1.0, 2.0]), ("A b", True, 12, [0.5, -1.0])], "name string, is_entity boolean, doc_count long, vector array<double>").write.parquet(f"{tmp_path}/v")
    cli.run(spark, cli.arguments(["--task", "vectors", "--input", f"{tmp_path}/v", "--output", f"{tmp_path}/out"]))
    parts = sorted((tmp_path / "out").glob("part-*"))
    assert "".join(p.read_text() for p in parts) == "2 2\nENTITY/A_b 0.5000 -1.0000\nthe 1.0000 2.0000\n"


def test_unknown_task():
    with pytest.raises(SystemExit):
        cli.arguments(["--task", "nothing"])


@pytest.mark.skipif(not DATA.exists(), reason="no tables here")
@pytest.mark.parametrize("name", ["count_children_topn", "split_links", "category_index_cyclic", "category_index_cutoff", "ancestors_cyclic", "ancestors_cutoff", "entity_ancestors", "json_claims", "json_claim_cases", "json_titles", "link_metrics", "page_categories", "repeated_scores", "vectors_text", "keyed_records", "line_shards"])
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    found = con.execute(catalogue.ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    got = catalogue.QUERIES[name](spark, str(DATA))
    assert sorted(got.columns) == sorted(columns)
    assert Counter(tuple(r[c] for c in columns) for r in got.collect()) == Counter(found.fetchall())
