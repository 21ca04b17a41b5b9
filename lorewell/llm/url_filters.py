"""URL filters: host-suffix and path-prefix expressions against a rule table.

Each distinct URL is expanded into the expressions that a rule could be (every
suffix of its host with as many labels as some rule has, with every prefix of its path whose length some
rule has). Expressions meet the rules in an equi-join on the first bytes of
their digests; full digests then confirm, and the longest rule wins (ties: the
longer host, then block before allow, then the smaller string).

Edge cases. A URL that is null or has no ``://`` has an empty host and path; no
rule fits it and it gets the default verdict. Every input row gives one result
row, repeated rows too; an empty table gives an empty result. Of equal rules
with two verdicts, block wins; rules with null parts are ignored. Extra
columns are kept, unless they clash with a result column: the result's wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, fits

RULES_SCHEMA = "host string, path string, verdict string"
#: Rules up to this number and of so many bytes are broadcast; more are joined by a shuffle, salted.
BROADCAST_RULES, BROADCAST_BYTES = 200_000, 32 << 20
#: Hexadecimal digits of a digest in the join key.
PREFIX_DIGITS = 8
#: Copies of each rule, in the shuffled join: a popular host is spread over so many tasks.
SALTS = 64


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, and the path of a URL; both empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _host_suffixes(host: Column, counts: list[int]) -> Column:
    """The last labels of a host, as many as in ``counts`` each."""
    labels = F.split(host, r"\.", -1)
    last = lambda n: F.when(F.size(labels) >= n, F.array_join(F.slice(labels, F.size(labels) - (n - 1), n), "."))
    return F.filter(F.array(*map(last, counts)) if counts else F.array(F.lit(None).cast("string")), lambda h: h.isNotNull())


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules (host, path, verdict) as a table."""
    row = lambda r: F.struct(*(F.lit(v).alias(k) for k, v in zip(("host", "path", "verdict"), r, strict=True)))
    if not rules:
        return spark.range(0).select(*(F.lit("").alias(k) for k in ("host", "path", "verdict")))
    return spark.range(1).select(F.explode(F.array(*map(row, rules))).alias("r")).select("r.*")


def url_filter(urls: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow", broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """The rows with host, path, rule (like ``net/``, or null) and verdict."""
    rules = (
        rules.select(ascii_lower(F.col("host")).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"))
        .dropna()
        .groupBy("r_host", "r_path")
        .agg(F.max("r_verdict").alias("r_verdict"))  # block is the greater string
        .withColumn("r_digest", _digest(F.col("r_host"), F.col("r_path")))
    )
    # As many lengths as rules have, not as many as there are rules; a length is below the longest URL's.
    lengths = sorted(r[0] for r in rules.select(F.length("r_path")).distinct().collect())
    labels = sorted(r[0] for r in rules.select(F.size(F.split("r_host", r"\.", -1))).distinct().collect())
    host, path = host_and_path(F.col("u_url"))
    distinct = urls.select(F.col(url_col).alias("u_url")).filter(F.col("u_url").contains("://")).distinct().select("u_url", host.alias("u_host"), path.alias("u_path"))
    prefixes = F.filter(F.array(*(F.when(F.length("u_path") >= n, F.substring("u_path", 1, n)) for n in lengths) if lengths else [F.lit(None).cast("string")]), lambda p: p.isNotNull())
    expressions = (
        distinct.select("u_url", F.explode(_host_suffixes(F.col("u_host"), labels)).alias("e_host"), prefixes.alias("e_paths"))
        .select("u_url", "e_host", F.explode("e_paths").alias("e_path"))
        .select("u_url", "e_host", "e_path", _digest(F.col("e_host"), F.col("e_path")).alias("e_digest"))
        .withColumn("key", F.substring("e_digest", 1, PREFIX_DIGITS))
    )
    rules = rules.withColumn("key", F.substring("r_digest", 1, PREFIX_DIGITS))
    if fits(rules, broadcast_rules) and (rules.agg(F.sum(F.octet_length("r_host") + F.octet_length("r_path"))).first()[0] or 0) <= BROADCAST_BYTES:
        met = expressions.join(F.broadcast(rules), "key")
    else:
        salted = rules.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = expressions.withColumn("salt", F.pmod(F.hash("u_url"), F.lit(SALTS))).join(salted, ["key", "salt"])
    order = F.struct(F.length("r_host") + F.length("r_path"), F.length("r_host"), "r_verdict", F.concat("r_host", "r_path").alias("rule"))
    best = met.filter("e_digest = r_digest").groupBy("u_url").agg(F.max(order).alias("best"))
    kept = [c for c in urls.columns if c not in {"host", "path", "rule", "verdict"}]
    host, path = host_and_path(F.col(url_col))
    return (
        urls.select(*(F.col(f"`{c}`") for c in kept))
        .join(best, F.col(f"`{url_col}`") == F.col("u_url"), "left")
        .select(*(F.col(f"`{c}`") for c in kept), host.alias("host"), path.alias("path"), F.col("best.rule").alias("rule"), F.coalesce("best.r_verdict", F.lit(default)).alias("verdict"))
    )


def url_filter_sql(rules: list[tuple[str, str, str]], default: str = "allow") -> str:
    """The same verdicts on ``pages`` by DuckDB, from the plain definition."""
    values = ", ".join("('{}', '{}', '{}')".format(*r) for r in rules)
    fit = "(p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path)"
    return f"""
        with r(host, path, verdict) as (values {values}),
        p as (
            select page_id,
                coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
                coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path, row_number() over () as k
            from pages),
        m as (
            select k, max(struct_pack(n := length(r.host) + length(r.path), h := length(r.host), v := r.verdict, rule := r.host || r.path)) as best
            from p join r on {fit} group by k)
        select page_id, host, path, best.rule as rule, coalesce(best.v, '{default}') as verdict from p left join m using (k)
    """
