"""Chat records of many layouts as canonical turns, and turns as training text.

A record is a JSON text. Its fingerprint is the hash of its nested field paths, whatever the
values; it selects the mapping that says where turns, roles and texts lie. Records whose
fingerprint no mapping declares come back with `layout` null and no turns, so that they can
be counted and mapped; formatting them is an error. The fingerprint is taken of the record
with empty texts, and the turns are read from its JSON, so texts may have any length.

The template marks each turn's role, text and end with control strings. Inside roles and
texts, every control string (of this and of other common templates) gets a backslash behind
its first character, one more if it has some already, so reading takes exactly that one away
again. The loss mask is a span of code points per turn: offset, length, and whether it counts.

Null roles and texts count as empty. Turns are sorted by turn, role and text; repeated rows
are turns of their own. Rows without a conversation id form one conversation. A conversation
is one value in the end, so it has to fit into a row (2 GB). Empty tables give empty results;
extra columns are left out. Everything is DataFrame expressions.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LEARNED_ROLES = ("assistant",)
CONTROL_STRINGS = (
    START,
    SEPARATOR,
    END,
    "<|startoftext|>",
    "<|endoftext|>",
    "<s>",
    "</s>",
    "<<SYS>>",
    "<</SYS>>",
    "[INST]",
    "[/INST]",
)


class Layout(NamedTuple):
    """A declared layout: field paths of its records, and where the turns lie.

    `paths` have one entry per field, nested ones joined by dots, `[]` for the elements of an
    array. With `fields`, each (role, path) is a turn if its text is not empty or it is not
    `optional`. With `items`, the turns are the elements of that array, role and text being
    two of their fields; `names` translates roles.
    """

    name: str
    paths: tuple[str, ...]
    fields: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    items: str = ""
    role: str = "role"
    text: str = "content"
    names: Mapping[str, str] = {}


LAYOUTS = (
    Layout("prompt", ("prompt", "response"), fields=(("user", "prompt"), ("assistant", "response"))),
    Layout(
        "instruction",
        ("instruction", "output", "system"),
        fields=(("system", "system"), ("user", "instruction"), ("assistant", "output")),
    ),
    Layout(
        "instruction_input",
        ("input", "instruction", "output"),
        fields=(("user", "instruction"), ("user", "input"), ("assistant", "output")),
        optional=("input",),
    ),
    Layout("messages", ("messages", "messages[].content", "messages[].role"), items="messages"),
    Layout(
        "from_value",
        ("conversations", "conversations[].from", "conversations[].value"),
        items="conversations",
        role="from",
        text="value",
        names={"human": "user", "gpt": "assistant"},
    ),
)


# Fingerprints ------------------------------------------------------------------------------


_OPENED = r'"(?:[^"\\]++|\\.)*+'
# A text, or a field's name as a whole.
_TEXT_OR_NAME = rf'(?s){_OPENED}(")(?!\s*+:)|({_OPENED}"\s*+:)'
_BLANK_FIELDS = r'\{"[^"\\]*+":""(?:,"[^"\\]*+":"")*+\}'
# What a JSON string may have at most in Java; the parser's own limit is 20 million.
LONGEST_STRING = (1 << 31) - 1
_MALFORMED = "_malformed"


def blanked(record: Column) -> Column:
    """A record with empty texts, and equal elements that follow one another once."""
    empty = F.regexp_replace(record, _TEXT_OR_NAME, "$1$1$2")
    return F.regexp_replace(empty, rf"({_BLANK_FIELDS})(?:,\1)++", "$1")


def shape(record: Column) -> Column:
    """The nested field paths of a record as one text: its schema without the scalar types.

    A VARIANT holds 128 MB and its parser takes no text of over 20 million characters, so
    only the fields go through it.
    """
    schema = F.schema_of_variant(F.try_parse_json(blanked(record)))
    scalar = r"(?!OBJECT<|ARRAY<)[A-Z_]+(\([0-9,]+\))?"
    without = F.regexp_replace(schema, ": " + scalar, "")
    return F.regexp_replace(without, f"ARRAY<{scalar}>", "ARRAY<>")


def declared_shape(paths: Sequence[str]) -> str:
    """The text that `shape` gives for records with these paths."""
    tree: dict = {}
    for path in sorted(paths):
        node = tree
        for step in path.split("."):
            node = node.setdefault(step.removesuffix("[]"), {})
    lists = {step[:-2] for path in paths for step in path.split(".") if step.endswith("[]")}

    def spelled(node: dict) -> str:
        fields = []
        for name, below in sorted(node.items()):
            inner = f": {spelled(below)}" if below else ""
            fields.append(name + (f": ARRAY<{spelled(below)}>" if name in lists else inner))
        return f"OBJECT<{', '.join(fields)}>"

    return spelled(tree)


def fingerprint(shape_: Column) -> Column:
    return F.xxhash64(shape_)


def canonical(records: DataFrame, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """Records (id, record) with `layout` and `turns`, an array of (role, text)."""
    spark = records.sparkSession
    declared = spark.createDataFrame(
        [(layout.name, declared_shape(layout.paths)) for layout in layouts], "layout string, declared string"
    ).select("layout", fingerprint(F.col("declared")).alias("print"))
    printed = records.select("id", "record", fingerprint(shape(F.col("record"))).alias("print"))
    # One row per declared layout.
    mapped = printed.join(F.broadcast(declared), "print", "left")
    turns = F.lit(None).cast("array<struct<role:string,text:string>>")
    options = {"maxStringLen": str(LONGEST_STRING), "columnNameOfCorruptRecord": _MALFORMED}
    for at, layout in enumerate(layouts):
        read = F.from_json("record", f"{_schema(layout)}, {_MALFORMED} string", options)
        mapped = mapped.withColumn(f"value_{at}", F.when(F.col("layout") == layout.name, read))
        value = F.col(f"value_{at}")
        found = F.when(value[_MALFORMED].isNull(), _turns(layout, value))
        turns = F.when(F.col("layout") == layout.name, found).otherwise(turns)
    found = mapped.select("id", "layout", turns.alias("turns"))
    return found.withColumn("layout", F.when(F.col("turns").isNotNull(), F.col("layout")))


def _schema(layout: Layout) -> str:
    """The fields that hold the turns, as from_json reads them."""
    if layout.items:
        tree: dict = {layout.items: f"array<struct<`{layout.role}`:string,`{layout.text}`:string>>"}
    else:
        tree = {path: "string" for _, path in layout.fields}

    def spelled(fields: dict, separator: str) -> str:
        below: dict = {}
        for path, kind in fields.items():
            first, _, rest = path.partition(".")
            below.setdefault(first, {})[rest] = kind
        return ", ".join(
            f"`{name}`{separator}" + (inner[""] if "" in inner else f"struct<{spelled(inner, ':')}>")
            for name, inner in below.items()
        )

    return spelled(tree, " ")


def _field(value: Column, path: str) -> Column:
    for name in path.split("."):
        value = value[name]
    return value


def _turns(layout: Layout, value: Column) -> Column:
    if layout.items:
        items = _field(value, layout.items)
        return F.transform(items, lambda item: _turn(_renamed(item[layout.role], layout.names), item[layout.text]))
    fields = []
    for role, path in layout.fields:
        text = _field(value, path)
        turn = _turn(F.lit(role), text)
        fields.append(F.when(F.coalesce(text, F.lit("")) != "", turn) if path in layout.optional else turn)
    return F.array_compact(F.array(*fields))


def _renamed(role: Column, names: Mapping[str, str]) -> Column:
    renamed = role
    for given, name in names.items():
        renamed = F.when(role == given, F.lit(name)).otherwise(renamed)
    return renamed


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


# Records -----------------------------------------------------------------------------------


def records_of_rows(rows: DataFrame, key: str) -> DataFrame:
    """Rows (key, turn, role, text) as records (id, record), each in the layout that holds its
    turns: two or three turns with fixed roles as prompt or instruction, dialogues of users and
    assistants as from/value lists, everything else as messages."""
    role, text = F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    turns = F.sort_array(F.collect_list(F.struct("turn", role, text))).alias("turns")
    grouped = rows.select(F.col(key).alias("id"), "turn", "role", "text").groupBy("id").agg(turns)
    grouped = grouped.withColumn("roles", F.transform("turns", lambda t: t["role"]))

    def said(at: int) -> Column:
        return F.get("turns", F.lit(at))["text"]

    def roles(*names: str) -> Column:
        return F.col("roles") == F.array(*map(F.lit, names))

    prompt = F.struct(said(0).alias("prompt"), said(1).alias("response"))
    instruction = F.struct(said(0).alias("system"), said(1).alias("instruction"), said(2).alias("output"))
    spoken = F.transform(
        "turns",
        lambda t: F.struct(
            F.when(t["role"] == "user", "human").otherwise("gpt").alias("from"), t["text"].alias("value")
        ),
    )
    messages = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))
    record = (
        F.when(roles("user", "assistant"), F.to_json(prompt))
        .when(roles("system", "user", "assistant"), F.to_json(instruction))
        .when(
            F.forall("roles", lambda r: r.isin("user", "assistant")), F.to_json(F.struct(spoken.alias("conversations")))
        )
        .otherwise(F.to_json(F.struct(messages.alias("messages"))))
    )
    return grouped.select("id", record.alias("record"))


# Template ----------------------------------------------------------------------------------


_FIRSTS = "[" + "".join(sorted({re.escape(c[0]) for c in CONTROL_STRINGS})) + "]"
_RESTS = "|".join(re.escape(c[1:]) for c in CONTROL_STRINGS)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"({_FIRSTS}\\*)(?=(?:{_RESTS}))", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"({_FIRSTS}\\*)\\(?=(?:{_RESTS}))", "$1")


def formatted(conversations: DataFrame, learned: Sequence[str] = LEARNED_ROLES) -> DataFrame:
    """Conversations (id, turns) as `formatted` text and `spans`, the loss mask.

    `spans` has a span for the text of each turn: start and length in code points of
    `formatted`, and `loss`, which says whether the turn is learned. A conversation without
    turns, whose record no layout takes, is an error.
    """
    name = F.coalesce(F.col("id").cast("string"), F.lit("null"))
    unread = F.raise_error(F.concat(F.lit("no layout takes the record of conversation "), name))
    taken = F.when(F.size("turns") > 0, F.col("turns")).otherwise(unread)
    turns = conversations.select("id", F.posexplode(taken).alias("pos", "turn"))
    text = escaped(F.col("turn.text"))
    head = F.concat(F.lit(START), escaped(F.col("turn.role")), F.lit(SEPARATOR))
    rows = turns.select(
        "id", "pos", head.alias("head"), text.alias("body"), F.col("turn.role").isin(*learned).alias("loss")
    )
    rows = rows.withColumn("chars", F.length("head") + F.length("body") + len(END) + 1)
    before = Window.partitionBy("id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("chars").over(before), F.lit(0)) + F.length("head")
    placed = rows.withColumn("start", start).groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "head", "body", "start", "loss"))).alias("rows")
    )
    return placed.select(
        "id",
        F.array_join(
            F.transform("rows", lambda r: F.concat(r["head"], r["body"], F.lit(END + "\n"))), ""
        ).alias("formatted"),
        F.transform(
            "rows",
            lambda r: F.struct(
                r["start"].alias("start"), F.length(r["body"]).cast("long").alias("length"), r["loss"].alias("loss")
            ),
        ).alias("spans"),
    )


def read_back(output: DataFrame) -> DataFrame:
    """Formatted conversations (id, formatted, spans) as `turns` and `learned`, the texts under
    the mask."""
    parts = F.split("formatted", re.escape(START))
    rows = output.select("id", "formatted", "spans", F.slice(parts, 2, F.size(parts)).alias("parts"))

    def turn(part: Column) -> Column:
        halves = F.split(part, re.escape(SEPARATOR))
        body = F.get(halves, F.lit(1))
        return F.struct(
            unescaped(F.get(halves, F.lit(0))).alias("role"),
            unescaped(F.left(body, F.length(body) - len(END) - 1)).alias("text"),
        )

    rows = rows.select("id", "formatted", F.transform("parts", turn).alias("turns"), "spans")
    masked = F.filter(F.arrays_zip("turns", "spans"), lambda z: z["spans"]["loss"])
    return rows.select("id", "formatted", "turns", F.transform(masked, lambda z: z["turns"]["text"]).alias("learned"))
