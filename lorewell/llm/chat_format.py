r"""Chat formatting: schema fingerprints pick the mapping, a template marks turns.

A row's fingerprint is a hash of the nested paths of the fields it has, as far as
some layout knows them. A registry of declarative mappings, keyed by such
hashes, turns each known layout (prompt and completion, instruction with input,
arrays of messages in several spellings, one row a turn) into canonical turns
(role, text). Layouts have optional fields; each choice of them has a hash of its
own in the registry. A row whose hash isn't there takes the first layout all of
whose required fields are there, the row's own or columns of the table. ``turn_rows``
does so for typed tables, also ones that unite several layouts, ``json_turns`` for JSON records.

The template writes every turn as ``<|turn|>role<|text|>text<|end|>``. Inside
roles and texts each backslash is doubled, and a single backslash breaks each
control string after its first character; no control string starts its second
character with a backslash, so dropping one backslash of each run's odd end
restores the text. The loss mask lists the spans of assistant texts in code
points of the output.

Edge cases. A null text or role counts as empty. Turns are ordered by turn,
then role, then text, null turns first; repeated rows are turns of their own.
Rows of one turn with a null conv_id form one conversation with a null id; a record of a
whole conversation is one by itself, whatever its id. A record whose
layout is unknown gives null turns and a null text, and keeps its fingerprint; a table
that no layout fits is an error. An empty table gives an
empty result. Extra columns are ignored.

A conversation becomes one string, so its rows do meet in one row of the
result; escaping and rendering happen before that, row by row, and places come
from running sums, so the work grows with the length and not with its square.
"""

from __future__ import annotations

import hashlib
from itertools import chain, combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Fixed list: control strings of this template and of common others.
CONTROLS = r"<\||<s>|</s>|<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|\[/?SYSTEM_PROMPT\]|<start_of_turn>|<end_of_turn>|<unk>|<pad>|<bos>|<eos>"
#: Code points of the pieces in which masked texts are read back.
PIECE = 256
TURNS_TYPE = "array<struct<role:string,text:string>>"


def escape(c: Column) -> Column:
    return F.regexp_replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), f"(?={CONTROLS})(.)", r"$1\\")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(\\?)", "$1")


# ----------------------------------------------------------- layouts and mappings


def fingerprint(paths: list[str]) -> str:
    """A hash of field paths; letter case and order don't count."""
    return hashlib.sha256("\n".join(sorted({p.lower() for p in paths})).encode()).hexdigest()[:16]


def _pair(a: str, b: str, system: str | None = None, extra: str | None = None) -> dict:
    optional = [x for x in (system, extra) if x]
    return {"kind": "pair", "prompt": a, "answer": b, "system": system, "extra": extra, "required": [a, b], "optional": optional}


def _list(field: str, role: str, text: str) -> dict:
    # An array without any of these fields has its name as its path.
    paths = [f"{field}[].{role}", f"{field}[].{text}"]
    return {"kind": "list", "field": field, "role": role, "text": text, "required": [], "optional": [], "either": [[field], paths[:1], paths[1:], paths]}


#: Declarative mappings. Any of them may have a conv_id beside it.
LAYOUTS: list[dict] = [
    _pair("instruction", "output", system="system", extra="input"),
    _pair("prompt", "response", system="system"),
    _pair("prompt", "completion", system="system"),
    _pair("question", "answer", system="system"),
    _list("messages", "role", "content"),
    _list("messages", "role", "text"),
    _list("conversations", "from", "value"),
    _list("dialogue", "speaker", "utterance"),
    {"kind": "rows", "key": "conv_id", "order": "turn", "role": "role", "text": "text", "required": [], "optional": ["turn", "role", "text"]},
]


def _variants(m: dict) -> list[list[str]]:
    """The sets of paths that a layout's rows may have."""
    free = ["conv_id", *m["optional"]]
    some = chain.from_iterable(combinations(free, k) for k in range(len(free) + 1))
    return [[*m["required"], *either, *chosen] for chosen in some for either in m.get("either", [[]])]


#: Fingerprint -> number of the layout; the first of those that share one.
MAPPINGS: dict[str, int] = {fingerprint(paths): k for k, m in reversed(list(enumerate(LAYOUTS))) for paths in _variants(m)}
#: All paths that some layout knows.
KNOWN = sorted({p for m in LAYOUTS for paths in _variants(m) for p in paths})
#: Fixed spellings of roles.
ROLES = {"human": "user", "prompter": "user", "customer": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "agent": "assistant"}


def canonical_role(role: Column) -> Column:
    low = F.lower(role)
    names = F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair))
    return F.coalesce(F.element_at(names, low), low, F.lit(""))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _pair_turns(get, m: dict) -> Column:
    prompt = F.coalesce(get(m["prompt"]), F.lit(""))
    if m["extra"]:
        more = get(m["extra"])
        prompt = F.when(F.coalesce(more, F.lit("")) == "", prompt).otherwise(F.concat(prompt, F.lit("\n\n"), more))
    turns = F.array(_turn(F.lit("user"), prompt), _turn(F.lit("assistant"), get(m["answer"])))
    if m["system"]:
        first = F.when(F.coalesce(get(m["system"]), F.lit("")) == "", F.array().cast(TURNS_TYPE)).otherwise(F.array(_turn(F.lit("system"), get(m["system"]))))
        turns = F.concat(first, turns)
    return turns


def _list_turns(rows: Column, m: dict) -> Column:
    return F.transform(rows, lambda r: _turn(canonical_role(r[m["role"]]), r[m["text"]]))


def _hash(paths: Column) -> Column:
    """``fingerprint`` of a column of lower-case paths."""
    return F.substring(F.sha2(F.array_join(F.array_sort(F.array_distinct(paths)), "\n"), 256), 1, 16)


def _chosen(layout: Column, fits: list[tuple[int, Column]]) -> Column:
    """The number of a row's layout: by its fingerprint, else the first that fits."""
    known = F.create_map(*(F.lit(x) for pair in MAPPINGS.items() for x in pair))
    return F.coalesce(F.try_element_at(known, layout), *(F.when(c, F.lit(k)) for k, c in fits))


def row_paths(record: Column) -> Column:
    """The field paths of one JSON record (two levels), in lower case."""
    top = F.try_variant_get(F.try_parse_json(record), "$", "map<string,variant>")

    def deeper(entry: Column) -> Column:
        name, value = entry["key"], entry["value"]
        rows = F.try_variant_get(value, "$", "array<map<string,variant>>")
        inner = F.array_distinct(F.flatten(F.transform(rows, lambda r: F.map_keys(r))))
        return F.when(F.size(inner) > 0, F.transform(inner, lambda k: F.concat(name, F.lit("[]."), k))).otherwise(F.array(name))

    return F.transform(F.flatten(F.transform(F.map_entries(top), deeper)), F.lower)


def json_turns(records: DataFrame, json_col: str = "record") -> DataFrame:
    """The rows with ``layout`` (fingerprint) and canonical ``turns`` (null for an unknown layout)."""
    parsed = F.try_parse_json(F.col(f"`{json_col}`"))
    get = lambda name: F.try_variant_get(parsed, f"$.{name}", "string")
    keep = [c for c in records.columns if c not in {"layout", "turns"}]
    paths = F.array_intersect(row_paths(F.col(f"`{json_col}`")), F.array(*map(F.lit, KNOWN)))
    rows = records.select(*(F.col(f"`{c}`") for c in keep), paths.alias("__paths")).withColumn("layout", _hash(F.col("__paths")))
    has = lambda names: F.size(F.array_intersect("__paths", F.array(*map(F.lit, names)))) == len(names)
    fits, made = [], {}
    for k, m in enumerate(LAYOUTS):
        if m["kind"] == "pair":
            made[k] = _pair_turns(get, m)
            fits.append((k, has(m["required"])))
        elif m["kind"] == "list":
            made[k] = _list_turns(F.try_variant_get(parsed, f"$.{m['field']}", "array<map<string,string>>"), m)
            fits.append((k, has(m["either"][-1])))
    rows = rows.withColumn("__chosen", _chosen(F.col("layout"), fits))
    turns = F.coalesce(F.lit(None).cast(TURNS_TYPE), *(F.when(F.col("__chosen") == k, c) for k, c in made.items()))
    return rows.withColumn("turns", turns).drop("__paths", "__chosen")


def _any(rows: Column, field: str) -> Column:
    """Whether a field of some struct in an array isn't null."""
    return F.exists(rows, lambda r: r[field].isNotNull())


def turn_rows(table: DataFrame) -> DataFrame:
    """Canonical turns of a typed table, one a row: conv_id, record, layout, known, turn, pos, role, text.

    Each row's mapping is picked by the hash of the paths of its own fields. A row
    that is a conversation by itself has a number, ``record``; role is null if it has no turn.
    """
    columns = {f.name.lower(): f for f in table.schema.fields}
    paths: list[Column] = []
    have: set[str] = set()
    for name, f in columns.items():
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            inner = {p: g.name for g in f.dataType.elementType.fields if (p := f"{name}[].{g.name.lower()}") in KNOWN}
            have |= set(inner)
            there = [(p, _any(c, g)) for p, g in inner.items()]
            paths += [F.when(has, F.lit(p)) for p, has in there]
            if name in KNOWN:
                none = c.isNotNull()
                for _, has in there:
                    none = none & ~F.coalesce(has, F.lit(False))
                paths.append(F.when(none, F.lit(name)))
        elif name in KNOWN:
            have.add(name)
            paths.append(F.when(c.isNotNull(), F.lit(name)))
    possible = {k: m for k, m in enumerate(LAYOUTS) if set(m["required"]) <= have and (m["kind"] != "list" or set(m["either"][-1]) <= have) and (m["kind"] != "rows" or {"conv_id", "turn", "role", "text"} <= have)}
    if not possible:
        raise ValueError(f"no mapping for the layout with columns {table.columns}")
    get = lambda name: F.col(f"`{columns[name].name}`").cast("string") if name in columns else F.lit(None).cast("string")
    entry = lambda turn, pos, role, text: F.struct(turn.cast("long").alias("turn"), pos.cast("int").alias("pos"), role.alias("role"), text.alias("text"))
    fits, entries = [], []
    for k, m in possible.items():
        if m["kind"] == "rows":
            made = F.array(entry(F.col(m["order"]), F.lit(0), F.coalesce(get(m["role"]), F.lit("")), F.coalesce(get(m["text"]), F.lit(""))))
        else:
            turns = _pair_turns(get, m) if m["kind"] == "pair" else _list_turns(F.col(m["field"]), m)
            made = F.transform(turns, lambda t, i: entry(F.lit(None), i, t["role"], t["text"]))
            some = [F.col(m["field"]).isNotNull()] if m["kind"] == "list" else [get(x).isNotNull() for x in m["required"]]
            fits.append((k, F.greatest(*some) if len(some) > 1 else some[0]))
        entries.append(F.when(F.col("chosen") == k, made))
    alone = F.col("chosen").isNull() | ~F.col("chosen").isin([k for k, m in possible.items() if m["kind"] == "rows"])
    conv = F.col("conv_id") if "conv_id" in columns else F.lit(None).cast("long")
    rows = table.withColumn("layout", _hash(F.array_compact(F.array(*paths)))).withColumn("chosen", _chosen(F.col("layout"), fits))
    rows = rows.withColumn("chosen", F.when(F.col("chosen").isin(list(possible)), F.col("chosen")))
    # Numbered before its turns become rows.
    rows = rows.withColumn("conv_id", conv).withColumn("record", F.when(alone, F.monotonically_increasing_id()))
    rows = rows.select("conv_id", "record", "layout", F.col("chosen").isNotNull().alias("known"), F.explode_outer(F.coalesce(*entries, F.lit(None))).alias("t"))
    return rows.select("conv_id", "record", "layout", "known", "t.*")


def table_turns(table: DataFrame) -> DataFrame:
    """Canonical turns of a typed table by conversation: conv_id, turns."""
    whole = F.when(F.col("role").isNotNull(), F.struct("turn", "pos", "role", "text"))
    grouped = turn_rows(table).groupBy("conv_id", "record").agg(F.max("known").alias("known"), F.sort_array(F.collect_list(whole)).alias("all"))
    return grouped.select("conv_id", F.when(F.col("known"), F.transform("all", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))).alias("turns"))


# ------------------------------------------------------------------- template


def format_rows(rows: DataFrame) -> DataFrame:
    """Rows of ``turn_rows`` -> one a conversation: conv_id, formatted, loss (spans, start and length in code points, of assistant texts)."""
    head, body = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT)), escape(F.col("text"))
    # Only lengths are made before rows meet by conversation, so a text is shuffled once.
    sized = rows.select("conv_id", "record", "known", "turn", "pos", "role", "text", F.length(head).alias("head"), F.length(body).alias("body"))
    before = Window.partitionBy("conv_id", "record").orderBy("turn", "pos", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("start", F.coalesce(F.sum(F.col("head").cast("long") + F.col("body") + len(END)).over(before), F.lit(0)))
    placed = placed.withColumn("piece", F.concat(head, body, F.lit(END)))
    part = F.when(F.col("piece").isNotNull(), F.struct("start", "piece"))
    span = F.when(F.col("role") == "assistant", F.struct((F.col("start") + F.col("head")).alias("start"), F.col("body").cast("long").alias("length")))
    grouped = placed.groupBy("conv_id", "record").agg(F.max("known").alias("known"), F.sort_array(F.collect_list(part)).alias("parts"), F.sort_array(F.collect_list(span)).alias("loss"))
    return grouped.select("conv_id", F.when(F.col("known"), F.array_join(F.col("parts.piece"), "")).alias("formatted"), F.when(F.col("known"), F.col("loss")).alias("loss"))


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted text."""
    pieces = F.filter(F.split(formatted, r"<\|end\|>", -1), lambda p: p != "")

    def turn(p: Column) -> Column:
        halves = F.split(F.substring(p, len(TURN) + 1, 1 << 30), r"<\|text\|>", -1)
        return F.struct(unescape(halves[0]).alias("role"), unescape(halves[1]).alias("text"))

    return F.transform(pieces, turn)


def format_conversations(table: DataFrame) -> DataFrame:
    """One row a conversation: conv_id, formatted, loss (spans of code points)."""
    return format_rows(turn_rows(table))


def digests(formatted: DataFrame) -> DataFrame:
    """What is read back from formatted conversations."""
    # Pieces of equal length, made once a row, so that a span is cut out without a walk from the start.
    pieces = F.struct("conv_id", "formatted", "loss", F.regexp_extract_all("formatted", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)).alias("pieces"))
    rows = formatted.select(F.explode(F.array(pieces)).alias("r")).select("r.*")

    def cut(s: Column) -> Column:
        first, last = F.floor(s["start"] / PIECE).cast("int"), F.floor((s["start"] + s["length"] - 1) / PIECE).cast("int")
        around = F.array_join(F.transform(F.sequence(first, last), lambda k: F.element_at("pieces", k + 1)), "")
        return F.when(s["length"] == 0, F.lit("")).otherwise(F.substr(around, (s["start"] % PIECE + 1).cast("int"), s["length"].cast("int")))

    masked = F.array_join(F.transform("loss", lambda s: unescape(cut(s))), "")
    read = rows.select("conv_id", "formatted", parse_turns(F.col("formatted")).alias("turns"), masked.alias("masked"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"),
        F.sha2("masked", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -7, a record of a whole conversation: both texts are other templates' control strings."""
    said = lambda role: F.struct(F.lit(role).alias("role"), F.lit("</s>[INST] ok [/INST]").alias("content"))
    return spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.array(said("user"), said("assistant")).alias("messages"))


def chat_format_sql() -> str:
    """The query's digests by DuckDB, from the plain definition."""
    size = lambda c: rf"length(regexp_replace(replace({c}, '\', '\\'), '({CONTROLS})', '.\1', 'g'))"
    return f"""
        with c as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        s as (
            select conv_id, count(*) as n_turns, string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as a,
                coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '') as m,
                cast(sum(length('{TURN}{TEXT}{END}') + {size("role")} + {size("text")}) as bigint) as formatted_chars
            from c group by conv_id)
        select conv_id, n_turns, sha256(a) as turns_sha256, cast(length(m) as bigint) as loss_chars, sha256(m) as loss_sha256, formatted_chars from s
    """
