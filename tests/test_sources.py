import bz2
import gzip
import json

import pytest

from pyspark.sql import Observation
from pyspark.sql import functions as F

from lorewell.sinks import files
from lorewell.sources import headers, lines, records, samples
from lorewell.streaming.lines import stream_lines


def values(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_paths(spark, tmp_path):
    (tmp_path / "a-1.txt").write_text("x\ny\rz\n")
    with gzip.open(tmp_path / "a-2.txt.gz", "wt") as f:
        f.write("1\n2\n")
    with bz2.open(tmp_path / "a-3.txt.bz2", "wt") as f:
        f.write("3\n")
    assert sorted(r[0] for r in lines.read_lines(spark, f"{tmp_path}/a-*", partitions=3).collect()) == ["1", "2", "3", "x", "y\rz"]
    assert lines.read_lines(spark, f"{tmp_path}/a-*", max_lines=2).count() == 2
    with pytest.raises(lines.NoFilesMatched):
        lines.read_lines(spark, f"{tmp_path}/b-*")
    (tmp_path / "d").mkdir()
    (tmp_path / "d/a-4.txt").write_text("4\n")
    assert len(lines.matching_files(spark, f"{tmp_path}/*a-*")) == 3 and len(lines.matching_files(spark, f"{tmp_path}/*a-*", across_folders=True)) == 4
    assert lines.read_lines(spark, f"{tmp_path}/a-2*").rdd.getNumPartitions() == 4
    assert sorted(r[0] for r in lines.iterate(lines.read_lines(spark, f"{tmp_path}/a-2*"))) == ["1", "2"]
    assert lines.object_path("gs://b/x/y") == ("b", "x/y") and lines.object_path("/x") is None


def test_headers(spark, tmp_path):
    good = [x.replace(lines.ANY, "7") for x in headers.dump_header("page")]
    lines.check_header(good, headers.dump_header("page"))
    bad = list(good)
    k = next(k for k, x in enumerate(bad) if "page_title" in x)
    bad[k - 1], bad[k] = bad[k], bad[k - 1]
    (tmp_path / "p.sql").write_text("\n".join(bad))
    with pytest.raises(lines.UnexpectedHeader, match=f"line {k - 1} "):
        lines.read_lines(spark, f"{tmp_path}/p.sql", headers.dump_header("page"))
    assert len(headers.dump_header("categorylinks")) == 44 and len(headers.dump_header("page")) == 50


def test_category_links(spark, tmp_path):
    rows = [b"(1,'A\\'b','k\r\xff(','2020-01-01','','u','page')", b"(2,'B','x','t','p','u','subcat')", b"(3,'C','x','t','p','u','file')"]
    (tmp_path / "c.sql").write_bytes(b"-- x\nINSERT INTO `categorylinks` VALUES " + b",".join(rows) + b";\n")
    read = lines.read_lines(spark, f"{tmp_path}/c.sql")
    assert [tuple(r) for r in records.category_links(read).collect()] == [(1, "A\\'b", "page"), (2, "B", "subcat")]
    assert [r[1] for r in records.category_links(read, types=None, unescape=True).collect()] == ["A'b", "B", "C"]


def test_pages(spark):
    row = "({},{},'T{}',{},0,0.5,'2022','2022',5,6,'wikitext',NULL)"
    read = values(spark, "INSERT INTO `page` VALUES " + ",".join(row.format(*x) for x in ((1, 0, 1, 0), (2, 14, 2, 0), (3, 1, 3, 0), (4, 0, 4, 1))) + ";", "other")
    assert [tuple(r) for r in records.pages(read).collect()] == [(1, "T1", 0, False), (2, "T2", 14, False)]
    assert records.pages(read, namespaces=None, drop_redirects=False).count() == 4


def claim(q, rank="normal", **snak):
    return {"rank": rank, "mainsnak": {"snaktype": "value", "datatype": "wikibase-item", "datavalue": {"type": "wikibase-entityid", "value": {"entity-type": "item", "id": q}}} | snak}


def test_entities(spark):
    oboe = {"id": "Q871", "labels": {"en": {"value": "oboe"}}, "aliases": {"en": [{"value": "a"}, {"value": "b"}]}, "sitelinks": {"enwiki": {"title": "The Oboe"}, "dewiki": {}}, "claims": {"P31": [claim("Q5"), claim("Q6", "deprecated"), claim("Q5")], "P279": [claim("Q7", snaktype="novalue")], "P9": [claim("Q1")], "P8": [{"mainsnak": {"snaktype": "value", "datatype": "string", "datavalue": {"type": "string", "value": "x"}}}]}}
    read = values(spark, "[", json.dumps(oboe) + ",", '{"id": Q44},', '{"id": "P31"}', '{"id": "Q3", "sitelinks": []}', '{"no": 1}', '{"id": "Q52"}', "", "]")
    got = {r["qid"]: r for r in records.entities(read).collect()}
    assert set(got) == {871, 52}
    assert tuple(got[871]) == (871, "The_Oboe", "oboe", 2, ["a", "b"], {31: [5, 5]})
    assert tuple(got[52]) == (52, None, None, 0, [], {})
    assert {r["qid"] for r in records.entities(read, lenient=True).collect()} == {3, 871, 52}
    assert set(records.entities(read, properties=None).filter("qid = 871").first()["claims"]) == {31, 9}
    assert records.entities(read, require_title=True).count() == 1
    seen = Observation("entities")
    records.entities(read, counts=seen).collect()
    assert seen.get == {"records": 5, "malformed": 3}
    with pytest.raises(Exception, match="malformed"):
        records.entities(read, mode="fail").collect()


def test_bad_json_lines(spark):
    assert records.entities(values(spark, "[", '{"id": "Q9"},', '{"id": Q8},', '{"id": "Q7"},', "]")).count() == 2


def test_ranks_and_vectors(spark):
    got = records.ranks(values(spark, "Entity,QRank", "Q12,9876543210", "Q1", "Q1,2,3"))
    assert [tuple(r) for r in got.collect()] == [(12, 9876543210)]
    got = records.word_vectors(values(spark, "2 3", "the 1.0 -2 3e-1", "ENTITY/A_b 1 2 3", "x 1 y 2"))
    assert [tuple(r) for r in got.collect()] == [("the", False, [1.0, -2.0, 0.3]), ("A_b", True, [1.0, 2.0, 3.0])]
    with pytest.raises(NotImplementedError):
        records.word_vectors(values(spark, "x"), format="glove")


def test_sinks(spark, tmp_path):
    some = spark.range(100).selectExpr("cast(id as string) as value")
    files.shard_lines(some, f"{tmp_path}/s", 5)
    assert len(list((tmp_path / "s").glob("*.gz"))) == 5
    assert sorted(int(r[0]) for r in lines.read_lines(spark, f"{tmp_path}/s/*.gz").collect()) == list(range(100))
    sized = files.sized_shards(spark.range(100).selectExpr("id", "'abcde' as value"), ["id"], 50)
    assert [r[1] for r in sized.groupBy("shard").count().orderBy("shard").collect()] == [10] * 10
    assert files.shard_name("x/y.gz", 7) == "x/y-00007.gz" and files.shard_name("a{}b", 12) == "a00012b"
    store = f"{tmp_path}/kv"
    rank = lambda *rows: files.keyed(spark.createDataFrame(rows, "qid long, qrank long"), "rank", "qid", parent="p")
    read = lambda **more: {r["key"]: json.loads(r["properties"])["qrank"] for r in files.query_store(spark, store, "rank", **more).collect()}
    files.upsert(spark, store, rank((1, 10), (2, 20), (3, 30)))
    files.upsert(spark, store, rank((2, 90)).withColumn("at", F.lit(1)).unionByName(rank((2, 21)).withColumn("at", F.lit(2))), order="at")
    assert read() == {"1": 10, "2": 21, "3": 30} == read(parent="p") and read(limit=1) == {"1": 10} and read(parent="q") == {}
    with pytest.raises(ValueError):
        files.upsert(spark, store, rank((2, 90), (2, 91)))
    files.delete_keys(spark, store, rank((1, 0)).select("kind", "key"))
    assert read() == {"2": 21, "3": 30}
    assert json.loads(files.write_metrics(f"{tmp_path}/m", {"n": some.groupBy().count()})) == {"n": [{"count": 100}]}
    files.write_records(samples.ranks(spark), f"{tmp_path}/r", "text")
    assert spark.read.text(f"{tmp_path}/r").count() == 6


def test_stream_of_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text("Entity,QRank\nQ1,5\nQ2,6\n")
    stream = stream_lines(spark, f"{tmp_path}/in", records.ranks)
    query = stream.writeStream.format("memory").queryName("ranks_seen").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start()
    query.awaitTermination(60)
    assert spark.table("ranks_seen").count() == 2
