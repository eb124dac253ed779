"""Chat formatting: schema fingerprints choose declarative mappings to canonical turns.

A record is a row of any of several layouts: a prompt with its response, an
instruction with input and output, or a list of messages under one of several
spellings. Its fingerprint is the hash of the nested field paths that hold a
value in that row; a layout declares the paths it is known by and, for each
canonical field, the expression that yields it. The row's fingerprint selects
the layout, so one table may mix layouts row by row.

Everything is column expressions: no Python runs on the executors.

The template marks turns as ``<|im_start|>role<|im_sep|>text<|im_end|>``.
Control strings inside roles and texts (``CONTROL``) get a backslash after
their first character, and backslashes are doubled; dropping every backslash
that stands before another character restores the text.

Defined cases: null texts are empty, null roles are the empty role; turns with
equal numbers are ordered by role and text, repeated rows stay repeated; rows
without any known field have no turns; an unknown fingerprint falls back to
the layout whose paths the record covers first, and to no turns if there is
none; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Strings with a meaning for chat models, as a regular expression behind their first character.
CONTROL = r"([<\[])(?=\||/?s>|</?SYS>>|/?INST\]|/?[a-z_]{1,20}\|>)"
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
TURNS = "array<struct<turn: bigint, role: string, text: string>>"


@dataclass(frozen=True)
class Layout:
    """The nested paths a layout is known by, and the SQL expression of its canonical turns."""

    name: str
    paths: tuple[str, ...]
    turns: str


def _turn(n: int, role: str, text: str) -> str:
    return f"named_struct('turn', {n}L, 'role', '{role}', 'text', {text})"


LAYOUTS = (
    Layout("messages", ("messages[].role", "messages[].text", "messages[].turn"),
           "transform(messages, m -> named_struct('turn', m.turn, 'role', m.role, 'text', m.text))"),
    Layout("conversations", ("conversations[].from", "conversations[].value"),
           "transform(conversations, (m, i) -> named_struct('turn', CAST(i AS BIGINT), 'role', "
           "CASE m.`from` WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' ELSE m.`from` END, 'text', m.value))"),
    Layout("prompt", ("prompt", "response"),
           f"array({_turn(0, 'user', 'prompt')}, {_turn(1, 'assistant', 'response')})"),
    Layout("instruction", ("instruction", "output"),
           f"array({_turn(0, 'user', 'instruction')}, {_turn(1, 'assistant', 'output')})"),
    Layout("instruction with input", ("instruction", "input", "output"),
           "array(" + _turn(0, "user", r"concat(instruction, '\n\n', input)") + f", {_turn(1, 'assistant', 'output')})"),
)


def _paths(kind: T.DataType, at: str, value: Column) -> list[tuple[str, Column]]:
    """(path, whether the row holds a value there) of every leaf below a column."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in _paths(f.dataType, f"{at}.{f.name}", value[f.name])]
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.StructType):
            # an element's field counts as there if the list is: messages may lack single values
            return [(f"{at}[].{f.name}", value.isNotNull()) for f in kind.elementType.fields]
        return [(f"{at}[]", value.isNotNull())]
    return [(at, value.isNotNull())]


def declared_paths() -> set[str]:
    return {p for lay in LAYOUTS for p in lay.paths}


def _hash(paths: Column) -> Column:
    return F.sha2(F.array_join(paths, "\n"), 256)


def fingerprint(df: DataFrame) -> Column:
    """The hash of the sorted nested paths, among those any layout declares, that hold a value in a row."""
    known = declared_paths()
    found = [(p, has) for f in df.schema.fields for p, has in _paths(f.dataType, f.name, F.col(f"`{f.name}`")) if p in known]
    return _hash(F.filter(F.array(*[F.when(has, F.lit(p)) for p, has in sorted(found, key=lambda x: x[0])]) if found
                          else F.array().cast("array<string>"), lambda p: p.isNotNull()))


def canonical_turns(df: DataFrame) -> Column:
    """The turns of a row, in order, by the layout that its fingerprint selects."""
    there = {p for f in df.schema.fields for p, _ in _paths(f.dataType, f.name, F.col(f"`{f.name}`"))}
    able = [lay for lay in LAYOUTS if set(lay.paths) <= there]
    chosen, print_ = F.lit(None).cast(TURNS), fingerprint(df)
    for lay in able:  # records of a layout with some value missing
        tops = {p.split("[")[0].split(".")[0] for p in lay.paths}
        covers = F.lit(True)
        for t in sorted(tops):
            covers = covers & F.col(f"`{t}`").isNotNull()
        chosen = F.coalesce(chosen, F.when(covers, F.expr(lay.turns).cast(TURNS)))
    exact = F.lit(None).cast(TURNS)
    for lay in reversed(able):
        mark = _hash(F.array(*[F.lit(p) for p in sorted(lay.paths)]))
        exact = F.when(print_ == mark, F.expr(lay.turns).cast(TURNS)).otherwise(exact)
    tidy = F.transform(F.coalesce(exact, chosen, F.array().cast(TURNS)), lambda t: F.struct(
        t["turn"].alias("turn"), F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")))
    return F.array_sort(tidy)


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), CONTROL, r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(?s:(.))", "$1")


def format_records(df: DataFrame, key: str = "conv_id") -> DataFrame:
    """``key``, formatted, loss (spans of assistant text: turn, start in the whole, length in code points).

    A span's ``within`` is its start inside its turn's own block.
    """
    blocks = df.select(key, canonical_turns(df).alias("turns"))
    blocks = blocks.select(key, F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(START), escaped(t["role"]), F.lit(SEP)).alias("head"), escaped(t["text"]).alias("body"),
        (t["role"] == "assistant").alias("learn"))).alias("blocks"))
    size = lambda b: F.length(b["head"]) + F.length(b["body"]) + F.lit(len(END))
    blocks = blocks.withColumn("spans", F.transform("blocks", lambda b, i: F.struct(
        i.alias("turn"), F.length(b["head"]).alias("within"), F.length(b["body"]).alias("length"), b["learn"].alias("learn"), size(b).alias("size"))))
    return blocks.select(
        key, F.array_join(F.transform("blocks", lambda b: F.concat(b["head"], b["body"], F.lit(END))), "").alias("formatted"),
        F.transform(F.filter("spans", lambda s: s["learn"]), lambda s: F.struct(s["turn"], s["within"], s["length"])).alias("loss"))


def read_back(df: DataFrame, key: str = "conv_id") -> DataFrame:
    """Turns and learnt text recovered from ``formatted`` and ``loss`` alone."""
    split = df.select(key, "formatted", "loss", F.filter(
        F.split("formatted", r"(?=<\|im_start\|>)"), lambda b: b != "").alias("blocks"))
    inner = lambda b: F.substring(b, len(START) + 1, F.length(b) - F.lit(len(START) + len(END)))
    return split.select(
        key, "formatted",
        F.transform("blocks", lambda b: F.struct(
            unescaped(F.substring_index(inner(b), SEP, 1)).alias("role"),
            unescaped(F.substring(b, F.instr(b, SEP) + F.lit(len(SEP)), F.length(b) - F.instr(b, SEP) + 1 - F.lit(len(SEP) + len(END)))).alias("text"))).alias("turns"),
        F.array_join(F.transform("loss", lambda s: unescaped(
            F.substring(F.element_at("blocks", s["turn"] + 1), s["within"] + 1, s["length"]))), "").alias("learnt"))


def records_of_rows(rows: DataFrame) -> DataFrame:
    """One record of the messages layout per conv_id, from rows (conv_id, turn, role, text)."""
    m = F.struct(F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), text().alias("text"))
    return rows.groupBy("conv_id").agg(F.collect_list(m).alias("messages"))


def text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def conversation_digests(conversations: DataFrame) -> DataFrame:
    """Per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Adds conversation -7, a prompt and response record whose texts hold control strings.
    """
    spark, hard = conversations.sparkSession, "</s>[INST] ok [/INST]"
    records = records_of_rows(conversations)
    own = spark.createDataFrame([(-7, hard, hard)], "conv_id long, prompt string, response string")
    back = read_back(format_records(records.unionByName(own, allowMissingColumns=True)))
    as_text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(as_text, 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
