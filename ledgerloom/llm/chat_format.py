"""Operator 6: chat formatting by schema fingerprints, in DataFrame functions only.

A record is JSON in one of many layouts.  The hash of its nested field paths
selects a declarative mapping, which turns the record into canonical
(role, text) turns.  Turns become one training text with control strings around
them; control strings inside texts are escaped reversibly, and the loss mask is
a list of spans over the assistant's text.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# control strings of the template (fixed values)
BEGIN = "<s>"
OPEN = "[INST:"
AFTER_ROLE = "] "
CLOSE = " [/INST]"
CLOSE_LOSS = " </s>"
LOSS_ROLE = "assistant"

# every one of these gets a backslash after it, so no control string can stand in a text
_SPECIAL = r"([\\\[\]<])"

# bytes of a record beyond which its paths are read from its skeleton
LONG_RECORD = 1 << 20
# a field name with its colon (group 1), or a string value between its quotes (groups 2 and 3);
# possessive, so that strings of any length are matched without recursion
_STRINGS = r'(?s)("(?:[^"\\]++|\\.)*+"\s*+:)|(")(?:[^"\\]++|\\.)*+(")'
# texts of any length, and an error for a record that is not as its layout says
_JSON_OPTIONS = {"maxStringLen": str(2**31 - 1), "mode": "FAILFAST"}


@dataclass(frozen=True)
class Mapping:
    """How the records of one layout become turns.

    ``examples`` are records whose field paths the layout has.  Either ``array``
    names a list whose items have a ``role`` and a ``text`` field, or ``fields``
    lists (role, field) in turn order.  ``roles`` renames role names.
    """

    name: str
    examples: tuple[str, ...]
    fields: tuple[tuple[str, str], ...] = ()
    array: str = ""
    role: str = ""
    text: str = ""
    roles: tuple[tuple[str, str], ...] = ()


def _array_layout(name: str, array: str, role: str, text: str, **more) -> Mapping:
    examples = tuple(json.dumps({array: items}) for items in ([], [{role: "", text: ""}]))
    return Mapping(name, examples, array=array, role=role, text=text, **more)


def _flat_layout(name: str, *fields: tuple[str, str]) -> Mapping:
    return Mapping(name, (json.dumps({field: "" for _, field in fields}),), fields=fields)


MAPPINGS = (
    _array_layout("messages", "messages", "role", "content"),
    _array_layout("turns", "turns", "role", "text"),
    _array_layout(
        "conversations", "conversations", "from", "value",
        roles=(("human", "user"), ("gpt", "assistant"), ("bot", "assistant")),
    ),
    _flat_layout("prompt_response", ("user", "prompt"), ("assistant", "response")),
    _flat_layout("prompt_completion", ("user", "prompt"), ("assistant", "completion")),
    _flat_layout("system_prompt_response", ("system", "system"), ("user", "prompt"), ("assistant", "response")),
    _flat_layout("instruction", ("user", "instruction"), ("assistant", "output")),
    _flat_layout("system_instruction", ("system", "system"), ("user", "instruction"), ("assistant", "output")),
    _flat_layout("instruction_input", ("user", "instruction"), ("user", "input"), ("assistant", "output")),
    _flat_layout("question_answer", ("user", "question"), ("assistant", "answer")),
)


def skeleton(payload: Column) -> Column:
    """A JSON text with empty string values, and one of each run of equal neighbours in its arrays: the same field paths."""
    empty = F.regexp_replace(payload, _STRINGS, "$1$2$3")
    return F.regexp_replace(empty, r"(\{[^{}]*+\})(?:\s*+,\s*+\1)++", "$1")


def schema_paths(payload: Column) -> Column:
    """Nested field paths of a JSON text, names in order, without the scalar types; null if it is no JSON.

    A Variant holds 128 MiB and its parser reads texts of 20,000,000 characters, so
    of a long record only the skeleton is parsed.
    """
    short = F.when(F.octet_length(payload) > LONG_RECORD, skeleton(payload)).otherwise(payload)
    schema = F.schema_of_variant(F.try_parse_json(short))
    return F.regexp_replace(schema, r"(?<=[ <])(?!OBJECT<|ARRAY<)[A-Z]+(?:\([^)]*\))?(?=[,>]|$)", "")


def fingerprint(payload: Column) -> Column:
    """Hash of a record's field paths; equal for records of one layout, whatever their values."""
    return F.sha2(schema_paths(payload), 256)


def _array_turns(payload: Column, m: Mapping) -> Column:
    schema = f"`{m.array}` array<struct<`{m.role}`:string,`{m.text}`:string>>"
    items = F.from_json(payload, schema, _JSON_OPTIONS)[m.array]
    renames = F.create_map(*(F.lit(x) for pair in m.roles for x in pair)) if m.roles else None

    def turn(item: Column) -> Column:
        role = F.coalesce(item[m.role], F.lit(""))
        if renames is not None:
            role = F.coalesce(F.element_at(renames, role), role)
        return F.struct(role.alias("role"), F.coalesce(item[m.text], F.lit("")).alias("text"))

    return F.transform(items, turn)


def _flat_turns(payload: Column, m: Mapping) -> Column:
    record = F.from_json(payload, ", ".join(f"`{field}` string" for _, field in m.fields), _JSON_OPTIONS)
    text = lambda field: F.coalesce(record[field], F.lit(""))
    return F.array(*(F.struct(F.lit(role).alias("role"), text(field).alias("text")) for role, field in m.fields))


def canonical_turns(
    records: DataFrame, payload: str = "payload", mappings: tuple[Mapping, ...] = MAPPINGS, strict: bool = False
) -> DataFrame:
    """Append ``fingerprint``, ``layout`` and ``turns`` (array of role, text) to JSON records.

    A record of no known layout (or no JSON, or null) has a null layout and null
    turns; with ``strict`` the job fails on one that is not null.  Null roles and
    texts become empty; a text may have any length.  Columns of the same names are
    replaced.
    """
    spark = records.sparkSession
    rows = [(m.name, example) for m in mappings for example in m.examples]
    known = (
        spark.createDataFrame(rows, "layout string, example string")
        .select("layout", fingerprint(F.col("example")).alias("fingerprint"))
        .collect()  # one row per mapping
    )
    names = F.create_map(*(F.lit(x) for r in dict((r["fingerprint"], r["layout"]) for r in known).items() for x in r))
    turns = None
    for m in mappings:
        own = _array_turns(F.col(payload), m) if m.array else _flat_turns(F.col(payload), m)
        chosen = F.col("layout") == m.name
        turns = F.when(chosen, own) if turns is None else turns.when(chosen, own)
    if strict:
        turns = F.coalesce(turns, F.when(F.col(payload).isNotNull(), F.raise_error(F.lit("a record has no turns"))))
    kept = records.drop(*({"fingerprint", "layout", "turns"} - {payload}))
    return (
        kept.withColumn("fingerprint", fingerprint(F.col(payload)))
        .withColumn("layout", F.element_at(names, F.col("fingerprint")))
        .withColumn("turns", turns)
    )


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _SPECIAL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _SPECIAL + r"\\", "$1")


def format_turns(records: DataFrame, key: str, turns: str = "turns", loss_role: str = LOSS_ROLE) -> DataFrame:
    """(key, formatted, loss_spans) of records with canonical turns.

    ``loss_spans`` are half-open code-point ranges of ``formatted`` that hold the
    texts of ``loss_role``, in order.  Null or empty turns give the begin mark
    alone.  Records are told apart by ``key``, which must be unique.  Offsets are
    running sums over a record's turns; a record is one row in and one row out.
    """
    turn = records.select(key, F.posexplode_outer(turns).alias("at", "turn"))
    loss = F.col("turn.role") == loss_role
    parts = turn.select(
        key,
        "at",
        loss.alias("loss"),
        F.concat(F.lit(OPEN), escape(F.col("turn.role")), F.lit(AFTER_ROLE)).alias("head"),
        escape(F.col("turn.text")).alias("body"),
        F.when(loss, CLOSE_LOSS).otherwise(CLOSE).alias("tail"),
    )
    size = F.length("head") + F.length("body") + F.length("tail")
    running = Window.partitionBy(key).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = parts.withColumn("end", F.length(F.lit(BEGIN)) + F.sum(size).over(running) - F.length("tail"))
    span = F.struct((F.col("end") - F.length("body")).alias("start"), F.col("end").alias("end"))
    row = F.struct("at", F.concat("head", "body", "tail").alias("piece"), F.when(F.col("loss"), span).alias("span"))
    grouped = placed.groupBy(key).agg(F.array_sort(F.collect_list(F.when(F.col("at").isNotNull(), row))).alias("rows"))
    return grouped.select(
        key,
        F.concat(F.lit(BEGIN), F.array_join(F.col("rows.piece"), "")).alias("formatted"),
        F.filter(F.col("rows.span"), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def parse_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted text, unescaped."""
    body = F.substr(formatted, F.lit(len(BEGIN) + 1))
    pieces = F.filter(F.split(body, r" \[/INST\]| </s>"), lambda p: p != "")
    role = lambda p: F.regexp_extract(p, r"(?s)^\[INST:(.*?)\] ", 1)
    text = lambda p: F.regexp_extract(p, r"(?s)^\[INST:.*?\] (.*)$", 1)
    return F.transform(pieces, lambda p: F.struct(unescape(role(p)).alias("role"), unescape(text(p)).alias("text")))


def loss_text(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(
        F.transform(loss_spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["end"] - s["start"]))), ""
    )


def as_records(rows: DataFrame, key: str, order: str, role: str = "role", text: str = "text") -> DataFrame:
    """(key, payload): rows of turns as JSON records, each in the layout its roles suit.

    Rows of equal ``order`` follow by role and text; a null role or text counts as
    empty.  A conversation is one record, gathered from its own rows; rows with a null
    key are one conversation, whose key is null.
    """
    turn = F.struct(
        F.col(order).alias("at"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("content"),
    )
    grouped = rows.groupBy(key).agg(F.array_sort(F.collect_list(turn)).alias("t"))
    roles, said = F.array_join(F.col("t.role"), ","), lambda i: F.col("t")[i]["content"]
    messages = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    payload = (
        F.when(roles == "user,assistant", F.to_json(F.struct(said(0).alias("prompt"), said(1).alias("response"))))
        .when(
            roles == "system,user,assistant",
            F.to_json(F.struct(said(0).alias("system"), said(1).alias("instruction"), said(2).alias("output"))),
        )
        .otherwise(F.to_json(F.struct(messages.alias("messages"))))
    )
    return grouped.select(key, payload.alias("payload"))
