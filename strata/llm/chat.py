"""Chat formatting (operator 8), with DataFrame functions only.

Records of many layouts become canonical turns: the nested field paths of a record
are hashed, and the hash selects a declarative mapping (``LAYOUTS``). Canonical
turns are then written under a template that marks them, with every control string
inside a role or a text escaped reversibly, next to a loss mask.

The loss mask has an entry for each trained text: the turn's number and the span
inside the marked turn, in code points.

Defined cases: a null role or text is empty; a conversation without rows does not
appear; rows of a conversation are taken by turn (nulls first), then by role and
text, so ties and repeated rows have one order; a null ``conv_id`` is one
conversation of its own; a record whose paths no mapping knows has null turns, and its
conversation appears with it in ``n_unknown``; a long text is one turn; an empty table
gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<role: string, text: string>>"


@dataclass(frozen=True)
class Layout:
    """How to read one layout: ``turns`` is SQL over the parsed record ``r``."""

    example: str  # a record of the layout; its field paths make the fingerprint
    turns: str


def _listed(path: str, role: str, text: str) -> str:
    return (
        f"transform(cast(variant_get(r, '$.{path}', 'array<variant>') as array<variant>), m -> named_struct("
        f"'role', coalesce(try_variant_get(m, '$.{role}', 'string'), ''), "
        f"'text', coalesce(try_variant_get(m, '$.{text}', 'string'), '')))"
    )


def _pair(*parts: tuple[str, str]) -> str:
    made = (f"named_struct('role', '{role}', 'text', coalesce(try_variant_get(r, '$.{path}', 'string'), ''))" for role, path in parts)
    return f"array({', '.join(made)})"


#: Known layouts. Variants with a missing or empty part have paths, and
#: so a fingerprint, of their own.
LAYOUTS = (
    Layout('{"messages": [{"role": "", "content": ""}]}', _listed("messages", "role", "content")),
    Layout('{"messages": [{"role": ""}]}', _listed("messages", "role", "content")),
    Layout('{"messages": [{"content": ""}]}', _listed("messages", "role", "content")),
    Layout('{"messages": []}', _listed("messages", "role", "content")),
    Layout('{"conversations": [{"from": "", "value": ""}]}', _listed("conversations", "from", "value")),
    Layout('{"conversations": []}', _listed("conversations", "from", "value")),
    Layout('{"turns": [{"role": "", "text": ""}]}', _listed("turns", "role", "text")),
    Layout('{"prompt": "", "completion": ""}', _pair(("user", "prompt"), ("assistant", "completion"))),
    Layout('{"prompt": "", "response": ""}', _pair(("user", "prompt"), ("assistant", "response"))),
    Layout('{"instruction": "", "output": ""}', _pair(("user", "instruction"), ("assistant", "output"))),
    Layout(
        '{"instruction": "", "input": "", "output": ""}',
        "array(named_struct('role', 'user', 'text', concat_ws('\\n', try_variant_get(r, '$.instruction', 'string'), "
        "nullif(try_variant_get(r, '$.input', 'string'), ''))), "
        "named_struct('role', 'assistant', 'text', coalesce(try_variant_get(r, '$.output', 'string'), '')))",
    ),
    Layout('{"question": "", "answer": ""}', _pair(("user", "question"), ("assistant", "answer"))),
    Layout('{"role": "", "text": ""}', "array(named_struct('role', try_variant_get(r, '$.role', 'string'), 'text', try_variant_get(r, '$.text', 'string')))"),
    Layout('{"role": ""}', "array(named_struct('role', try_variant_get(r, '$.role', 'string'), 'text', ''))"),
    Layout('{"text": ""}', "array(named_struct('role', '', 'text', try_variant_get(r, '$.text', 'string')))"),
    Layout("{}", "array(named_struct('role', '', 'text', ''))"),
)


def _shape(variant: Column) -> Column:
    """Hash of a record's nested field paths; fields' order and scalar types do not count."""
    scalar = r"\b(?!OBJECT\b|ARRAY\b)[A-Z]+(\(\d+,\s*\d+\))?(?=[,>]|$)"
    return F.xxhash64(F.regexp_replace(F.schema_of_variant(variant), scalar, "?"))


def fingerprint(record: Column) -> Column:
    """Hash of a JSON record's nested field paths; null fields count as scalars of their path."""
    return _shape(F.try_parse_json(record))


def _fields(layouts: tuple[Layout, ...]) -> tuple[set[str], set[str]]:
    """Field names that the layouts use: of records, and of the items of their lists."""
    outer, inner = set(), set()
    for layout in layouts:
        for name, value in json.loads(layout.example).items():
            outer.add(name)
            inner.update(k for item in value for k in item) if isinstance(value, list) else None
    return outer, inner


def _needed(layouts: tuple[Layout, ...]) -> Column:
    """The record ``_r`` without fields that no layout uses."""
    outer, inner = (", ".join(f"'{n}'" for n in sorted(names)) for names in _fields(layouts))
    item = f"to_variant_object(map_filter(try_variant_get(m, '$', 'map<string, variant>'), (k, v) -> k IN ({inner})))"
    items = f"transform(try_variant_get(v, '$', 'array<variant>'), m -> if(schema_of_variant(m) LIKE 'OBJECT%', {item}, m))"
    known = f"map_filter(try_variant_get(_r, '$', 'map<string, variant>'), (k, v) -> k IN ({outer}))"
    listed = f"if(schema_of_variant(v) LIKE 'ARRAY%', to_variant_object({items}), v)"
    some = f"schema_of_variant(_r) LIKE 'OBJECT%' AND cardinality({known}) > 0"
    return F.expr(f"if({some}, to_variant_object(transform_values({known}, (k, v) -> {listed})), NULL)")


def canonical_turns(df: DataFrame, record: str, into: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Column ``into``: the turns of the JSON text in column ``record``, null for unknown layouts.

    A record of another shape is fingerprinted once more without the fields that no layout
    uses, so ids, sources and other extra fields do not make a layout unknown.
    """
    parsed = df.withColumns({"_r": F.try_parse_json(record), "_paths": fingerprint(F.col(record))})
    shapes = F.array(*(fingerprint(F.lit(layout.example)) for layout in layouts))
    listed = F.array_contains(shapes, F.col("_paths"))
    shaped = parsed.withColumn("_paths", F.when(listed, F.col("_paths")).otherwise(_shape(_needed(layouts))))
    chosen = None
    for layout in layouts:
        known = F.col("_paths") == fingerprint(F.lit(layout.example))
        turns = F.expr(f"element_at(transform(array(_r), r -> cast({layout.turns} as {TURNS})), 1)")
        chosen = F.when(known, turns) if chosen is None else chosen.when(known, turns)
    return shaped.withColumn(into, chosen).drop("_r", "_paths")


@dataclass(frozen=True)
class Template:
    """Marks of a turn, the strings no role or text may hold unescaped, and who is trained."""

    turn: str = "<|turn|>"
    text: str = "<|text|>"
    end: str = "<|end|>"
    controls: tuple[str, ...] = (
        "<|turn|>", "<|text|>", "<|end|>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>",
        "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "</s>", "<unk>",
    )
    trained: tuple[str, ...] = ("assistant",)

    def escape(self, text: Column) -> Column:
        """Doubles backslashes and puts one behind the first character of a control string."""
        out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        for c in self.controls:
            out = F.replace(out, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
        return out

    def unescape(self, text: Column) -> Column:
        out = text
        for c in reversed(self.controls):
            out = F.replace(out, F.lit(f"{c[0]}\\{c[1:]}"), F.lit(c))
        return F.replace(out, F.lit("\\\\"), F.lit("\\"))

    def marked(self, role: Column, text: Column) -> Column:
        return F.concat(F.lit(self.turn), self.escape(role), F.lit(self.text), self.escape(text), F.lit(self.end))

    def span(self, role: Column, text: Column) -> Column:
        start = len(self.turn) + len(self.text) + F.char_length(self.escape(role))
        return F.struct(start.alias("start"), F.char_length(self.escape(text)).alias("length"))


def _quoted(text: str) -> str:
    return f"\\Q{text}\\E"


def format_conversations(rows: DataFrame, template: Template = Template(), block: int = 64) -> DataFrame:
    """``conv_id``, ``formatted``, ``loss_mask`` and ``n_unknown`` of every conversation.

    ``n_unknown`` counts the records that no layout could read; they are not in the
    text. ``rows`` has ``conv_id``, ``turn`` and canonical ``turns`` (an array, usually of
    one). Blocks of turns are put together first, so that a long conversation meets
    in one task as a few blocks and not as all its rows.
    """
    each = rows.select(
        "conv_id", "turn", F.floor(F.col("turn") / block).alias("block"), F.col("turns").isNull().alias("unknown"),
        F.posexplode_outer("turns").alias("part", "t"),
    ).select("conv_id", "block", "turn", "unknown", "part", F.coalesce("t.role", F.lit("")).alias("role"), F.coalesce("t.text", F.lit("")).alias("text"))
    role, text = F.col("role"), F.col("text")
    item = F.struct(
        "turn", "part", "role", "text",
        template.marked(role, text).alias("marked"),
        F.when(role.isin(*template.trained), template.span(role, text)).alias("span"),
    )
    ordered = F.transform(
        F.array_sort(F.collect_list(F.when(F.col("part").isNotNull(), item))), lambda t: F.struct(t["marked"].alias("marked"), t["span"].alias("span"))
    )
    blocks = each.groupBy("conv_id", "block").agg(ordered.alias("items"), F.count_if("unknown").alias("unknown"))
    whole = blocks.groupBy("conv_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("block", "items"))), lambda b: b["items"])).alias("items"),
        F.sum("unknown").alias("n_unknown"),
    )
    mask = F.transform("items", lambda t, i: F.struct(i.alias("turn"), t["span"].alias("span")))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("items", lambda t: t["marked"]), "").alias("formatted"),
        F.filter(mask, lambda m: m["span"].isNotNull()).alias("loss_mask"),
        "n_unknown",
    )


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Adds ``turns`` and ``loss_text``, both taken from the formatted text and its mask."""
    pieces = F.slice(F.split("formatted", _quoted(template.turn)), F.lit(2), F.size(F.split("formatted", _quoted(template.turn))))
    read = formatted.withColumn("pieces", pieces)
    end = len(template.end)

    def turn(piece: Column) -> Column:
        halves = F.split(piece, _quoted(template.text))
        body = F.substring(halves[1], F.lit(1), F.char_length(halves[1]) - end)
        return F.struct(template.unescape(halves[0]).alias("role"), template.unescape(body).alias("text"))

    def masked(m: Column) -> Column:
        return template.unescape(
            F.substring(F.element_at("pieces", m["turn"] + 1), m["span"]["start"] - len(template.turn) + 1, m["span"]["length"])
        )

    return read.withColumns({
        "turns": F.transform("pieces", turn),
        "loss_text": F.array_join(F.transform("loss_mask", masked), ""),
    }).drop("pieces")


def records(conversations: DataFrame) -> DataFrame:
    """Each row of a table of turns as a JSON record of the layout it has; nulls are left out."""
    return conversations.select("conv_id", "turn", F.to_json(F.struct("role", "text")).alias("record"))


def chat(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """Format the turns of ``conversations`` and read the result back."""
    turns = canonical_turns(records(conversations), "record", "turns")
    return read_back(format_conversations(turns, template), template)


def digests(chats: DataFrame) -> DataFrame:
    """The counts and hashes that describe each formatted conversation."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chats.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
