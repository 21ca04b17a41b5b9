"""Parsers of lines (``value``) into records, on the JVM.

A record that can't be read is dropped with ``mode="drop"`` and ends the query
with ``mode="fail"``. ``counts``, an ``Observation``, gets the numbers of
``records`` and ``malformed`` ones when the query runs, at no second reading.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..schemas import INSTANCE_OF, SUBCLASS_OF


def _checked(rows: DataFrame, bad: Column, what: str, mode: str, counts: Observation | None) -> DataFrame:
    """Drop the bad rows, or fail at the first."""
    if mode not in ("drop", "fail"):
        raise ValueError(f"mode is drop or fail, not {mode!r}")
    if counts is not None:
        rows = rows.observe(counts, F.count(F.lit(1)).alias("records"), F.count_if(bad).alias("malformed"))
    if mode == "fail":
        return rows.filter(F.when(bad, F.raise_error(F.lit(f"malformed {what}")).cast("boolean")).otherwise(F.lit(True)))
    return rows.filter(~bad)


def _once(rows: DataFrame, *columns: Column) -> DataFrame:
    """The columns, evaluated once a row: what filters them later isn't moved below, and so repeated."""
    return rows.select(F.explode(F.array(F.struct(*columns))).alias("r")).select("r.*")


# ------------------------------------------------------------------- SQL dumps

_INSERT = r"(?d)^INSERT INTO `.*` VALUES"
#: A field up to the next delimiter; (?d) since dots must match \r and the like in raw bytes.
_ANY = "(.*?)"


def _tuples(lines: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row per tuple of the INSERT lines, the fields as f1, f2 and so on."""
    pattern = r"(?d)\(" + ",".join(fields) + r"\)"
    tuples = lines.filter(F.col("value").rlike(_INSERT)).select(F.explode(F.regexp_extract_all("value", F.lit(pattern), F.lit(0))).alias("t"))
    return tuples.select(*(F.regexp_extract("t", pattern, k).alias(f"f{k}") for k in range(1, len(fields) + 1)))


def _text(c: Column, unescape: bool) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1") if unescape else c


def category_links(lines: DataFrame, types: Sequence[str] | None = ("page", "subcat"), mode: str = "drop", unescape: bool = False, counts: Observation | None = None) -> DataFrame:
    """Links of a categorylinks dump: page_id, category, cl_type. No types: all."""
    raw = _tuples(lines, [r"(\d+)", *[f"'{_ANY}'"] * 6])
    rows = raw.select(F.expr("try_cast(f1 as bigint)").alias("page_id"), _text(F.col("f2"), unescape).alias("category"), F.col("f7").alias("cl_type"))
    rows = _checked(rows, F.col("page_id").isNull() | F.contains("category", F.lit("�")) | ~F.is_valid_utf8("category"), "category link", mode, counts)
    return rows.filter(F.col("cl_type").isin(*types)) if types else rows


def pages(lines: DataFrame, namespaces: Sequence[int] | None = (0, 14), drop_redirects: bool = True, mode: str = "drop", unescape: bool = False, counts: Observation | None = None) -> DataFrame:
    """Pages of a page dump: page_id, title, namespace, is_redirect. No namespaces: all."""
    number = r"(\d+)"
    raw = _tuples(lines, [number, number, f"'{_ANY}'", number, *[_ANY] * 4, number, number, _ANY, _ANY])
    rows = raw.select(F.expr("try_cast(f1 as bigint)").alias("page_id"), _text(F.col("f3"), unescape).alias("title"), F.expr("try_cast(f2 as int)").alias("namespace"), (F.expr("try_cast(f4 as bigint)") != 0).alias("is_redirect"))
    rows = _checked(rows, F.col("page_id").isNull() | F.col("namespace").isNull() | F.col("is_redirect").isNull() | F.contains("title", F.lit("�")) | ~F.is_valid_utf8("title"), "page", mode, counts)
    if namespaces:
        rows = rows.filter(F.col("namespace").isin(*namespaces))
    return rows.filter(~F.col("is_redirect")) if drop_redirects else rows


# ------------------------------------------------------------------- JSON dump


def _number(c: Column, letter: str) -> Column:
    """The number of an id like Q12; null for other texts."""
    return F.when(F.startswith(c, F.lit(letter)), F.substr(c, F.lit(2)).try_cast("long"))


# The fields of an entity that are read; the last gets what doesn't fit them.
_CLAIM = "struct<rank: string, mainsnak: struct<snaktype: string, datatype: string, datavalue: struct<type: string, value: variant>>>"
_ENTITY = (
    "id string, labels struct<en: struct<value: string>>, sitelinks map<string, struct<title: string>>, "
    f"aliases struct<en: array<struct<value: string>>>, claims map<string, array<{_CLAIM}>>, broken string"
)


def entities(lines: DataFrame, require_title: bool = False, properties: Sequence[int] | None = (INSTANCE_OF, SUBCLASS_OF), mode: str = "drop", lenient: bool = False, counts: Observation | None = None) -> DataFrame:
    """Entities of a JSON dump, one object a line inside an array.

    claims: property -> items of its claims that aren't deprecated, in order, repeats
    kept. lenient: an empty array where an object is meant counts as one without fields.
    Objects without an id are no entities; those of other shapes are malformed.
    """
    line = F.regexp_replace(F.regexp_replace("value", r"^[\s\x1c-\x1f\x85\xa0]+|[\s\x1c-\x1f\x85\xa0]+$", ""), r",$", "")
    if lenient:
        line = F.regexp_replace(line, r'"(labels|aliases|sitelinks|claims)"\s*:\s*\[\s*\]', '"$1":{}')
    rows = lines.select(line.alias("line")).filter(~F.col("line").isin("", "[", "]"))
    read = F.from_json("line", _ENTITY, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"})
    rows = _once(rows, read.alias("e")).filter("e.id is not null or e.broken is not null")
    pairs = F.map_entries("e.claims")
    if properties:
        wanted = [F.lit(f"P{p}") for p in properties]
        pairs = F.filter(pairs, lambda c: c["key"].isin(*wanted))

    def items(claims: Column) -> Column:
        value = lambda c, path: F.try_variant_get(c["mainsnak"]["datavalue"]["value"], path, "string")
        fine = F.filter(
            claims,
            lambda c: (F.coalesce(c["rank"], F.lit("")) != "deprecated")
            & (c["mainsnak"]["snaktype"] == "value")
            & (c["mainsnak"]["datatype"] == "wikibase-item")
            & (c["mainsnak"]["datavalue"]["type"] == "wikibase-entityid")
            & (value(c, "$.entity-type") == "item")
            & value(c, "$.id").isNotNull(),
        )
        return F.transform(fine, lambda c: _number(value(c, "$.id"), "Q"))

    listed = F.transform(pairs, lambda c: F.struct(_number(c["key"], "P").cast("int").alias("pid"), items(c["value"]).alias("items")))
    rows = _once(
        rows,
        _number(F.col("e.id"), "Q").alias("qid"),
        F.replace(F.element_at("e.sitelinks", F.lit("enwiki"))["title"], F.lit(" "), F.lit("_")).alias("title"),
        F.col("e.labels.en.value").alias("label"),
        F.coalesce(F.size(F.map_keys("e.sitelinks")), F.lit(0)).alias("sitelinks"),
        F.coalesce(F.col("e.aliases.en.value"), F.array().cast("array<string>")).alias("aliases"),
        F.coalesce(listed, F.array().cast("array<struct<pid:int,items:array<bigint>>>")).alias("listed"),
        (F.col("e.broken").isNotNull() | F.exists(F.coalesce(F.map_keys("e.claims"), F.array().cast("array<string>")), lambda k: _number(k, "P").isNull())).alias("odd"),
    )
    bad_item = F.exists("listed", lambda c: F.exists(c["items"], lambda q: q.isNull()))
    rows = _checked(rows, F.col("qid").isNull() | F.col("odd") | F.coalesce(bad_item, F.lit(True)), "entity", mode, counts)
    claims = F.map_from_entries(F.filter("listed", lambda c: F.size(c["items"]) > 0))
    rows = rows.select("qid", "title", "label", "sitelinks", "aliases", claims.alias("claims"))
    return rows.filter((F.col("title") != "") & F.col("title").isNotNull()) if require_title else rows


# ---------------------------------------------------------------- ranks, vectors


def ranks(lines: DataFrame, mode: str = "drop", counts: Observation | None = None) -> DataFrame:
    """Ranks of lines like ``Q5,123``: qid, qrank. The header line is skipped."""
    parts = F.split(F.trim("value"), ",", -1)
    rows = lines.select(parts.alias("p")).filter(F.col("p")[0] != "Entity")
    out = rows.select(F.size("p").alias("n"), _number(F.col("p")[0], "Q").alias("qid"), F.try_element_at("p", F.lit(2)).try_cast("long").alias("qrank"))
    return _checked(out, (F.col("n") != 2) | F.col("qid").isNull() | F.col("qrank").isNull(), "rank", mode, counts).select("qid", "qrank")


def word_vectors(lines: DataFrame, format: str = "word2vec", mode: str = "drop", counts: Observation | None = None) -> DataFrame:
    """Vectors of lines ``name x1 x2 ...``: name, is_entity, vector. Lines of up to two words are headers."""
    if format != "word2vec":
        raise NotImplementedError(f"format {format!r}")
    parts = lines.select(F.split(F.regexp_replace("value", r"^\s+|\s+$", ""), " ", -1).alias("p")).filter(F.size("p") > 2)
    name, entity = F.col("p")[0], F.startswith(F.col("p")[0], F.lit("ENTITY/"))
    vector = F.transform(F.slice("p", 2, F.size("p") - 1), lambda x: x.try_cast("double"))
    rows = parts.select(F.when(entity, F.substr(name, F.lit(8))).otherwise(name).alias("name"), entity.alias("is_entity"), vector.alias("vector"))
    return _checked(rows, F.exists("vector", lambda x: x.isNull()), "vector", mode, counts)
