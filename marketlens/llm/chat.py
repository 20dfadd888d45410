"""Chat formatting by schema fingerprints, in DataFrame functions only.

Sources hold conversations in many layouts: a row per turn, message lists, prompt
and completion, instruction and output. The nested field paths that hold a value
in a record (``messages[].role``) are sorted and hashed; the hash selects a
declarative mapping (``LAYOUTS``), and the mapping makes canonical turns of the
record. Records of one table may differ in layout: a path counts where the record
has a value. Fields that no layout names are extra and not read.

The template is ``<|im_start|>role, line break, text<|im_end|>, line break``. In a
text every ``<`` that is followed by backslashes, or none, and a ``|`` gets one more
backslash behind it: no control string is left, and taking one backslash away gives
the text back. Roles are percent-encoded, which leaves plain names as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

START, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"
TURNS = "array<struct<role: string, text: string>>"


@dataclass(frozen=True)
class Say:
    """One turn of a fixed role; several fields are joined by an empty line. Without a value, no turn."""

    role: str
    fields: tuple[str, ...]


@dataclass(frozen=True)
class Each:
    """A turn per element of a list; ``text`` may be a list of parts (``content[].text``)."""

    items: str
    role: str
    text: str
    names: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Alternate:
    """A list of texts, said by the two roles in turns."""

    items: str
    roles: tuple[str, str] = ("user", "assistant")


@dataclass(frozen=True)
class Rows:
    """A row per turn; the rows of one ``conv_id`` make a conversation."""

    order: str
    role: str
    text: str


@dataclass(frozen=True)
class Layout:
    """The paths a record of this layout has, those it may have, and what its turns are."""

    name: str
    needed: tuple[str, ...]
    optional: tuple[str, ...]
    turns: tuple[Say | Each | Alternate | Rows, ...]

    def path_sets(self) -> list[tuple[str, ...]]:
        return [(*self.needed, *some) for n in range(len(self.optional) + 1)
                for some in combinations(self.optional, n)]


ID = "conv_id"
SYSTEM = Say("system", ("system",))
LAYOUTS = (
    Layout("turn_rows", (), (ID, "turn", "role", "text"), (Rows("turn", "role", "text"),)),
    Layout("messages", ("messages[].role",), ("messages[].content", "system", ID),
           (SYSTEM, Each("messages", "role", "content"))),
    Layout("message_parts", ("messages[].role", "messages[].content[].text"), ("system", ID),
           (SYSTEM, Each("messages", "role", "content[].text"))),
    Layout("from_value", ("conversations[].from",), ("conversations[].value", "system", ID),
           (SYSTEM, Each("conversations", "from", "value", {"human": "user", "gpt": "assistant"}))),
    Layout("instruction", ("instruction",), ("input", "output", "system", ID),
           (SYSTEM, Say("user", ("instruction", "input")), Say("assistant", ("output",)))),
    Layout("prompt_completion", ("prompt",), ("completion", "system", ID),
           (SYSTEM, Say("user", ("prompt",)), Say("assistant", ("completion",)))),
    Layout("preference", ("prompt", "chosen"), ("rejected", "system", ID),
           (SYSTEM, Say("user", ("prompt",)), Say("assistant", ("chosen",)))),
    Layout("question_answer", ("question",), ("answer", "system", ID),
           (SYSTEM, Say("user", ("question",)), Say("assistant", ("answer",)))),
    Layout("dialog", ("dialog[]",), ("system", ID), (SYSTEM, Alternate("dialog"))),
)


def fingerprint_of(paths: Sequence[str]) -> str:
    return hashlib.md5("\n".join(sorted(paths)).encode()).hexdigest()


def known_fingerprints(layouts: Sequence[Layout]) -> dict[str, str]:
    """Layout name by fingerprint: one per choice of optional paths."""
    known: dict[str, str] = {}
    for layout in layouts:
        for paths in layout.path_sets():
            other = known.setdefault(fingerprint_of(paths), layout.name)
            if other != layout.name:
                raise ValueError(f"{other} and {layout.name} share the paths {sorted(paths)}")
    return known


def _leaves(kind: DataType, value: Column, path: str) -> list[tuple[str, Column]]:
    """Leaf paths of a column, each with whether the record has a value there."""
    if isinstance(kind, StructType):
        return [leaf for f in kind.fields for leaf in _leaves(f.dataType, value[f.name], f"{path}.{f.name}".lstrip("."))]
    if isinstance(kind, ArrayType):
        inner = _leaves(kind.elementType, F.lit(None), "")

        def held(i: int) -> Column:
            return F.coalesce(F.exists(value, lambda item: _leaves(kind.elementType, item, "")[i][1]), F.lit(False))
        return [(f"{path}[].{name}".rstrip("."), held(i)) for i, (name, _) in enumerate(inner)]
    return [(path, value.isNotNull())]


def paths_of(df: DataFrame) -> dict[str, Column]:
    return {path.replace("].[", "][") : held for f in df.schema.fields
            for path, held in _leaves(f.dataType, F.col(f"`{f.name}`"), f.name)}


def fingerprint(df: DataFrame, layouts: Sequence[Layout] = LAYOUTS) -> Column:
    """Hash of the sorted paths at which a record has values, of those that any layout names."""
    named = {p for layout in layouts for p in (*layout.needed, *layout.optional)}
    held = sorted((p, value) for p, value in paths_of(df).items() if p in named) if named else []
    found = F.array(*[F.when(value, F.lit(p)) for p, value in held]) if held else F.array().cast("array<string>")
    return F.md5(F.array_join(found, "\n"))  # nulls are left out


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role.cast("string"), F.lit("")).alias("role"),
                    F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _turns(rule: Say | Each | Alternate) -> Column:
    if isinstance(rule, Say):
        said = F.array_compact(F.array(*[F.col(f"`{f}`").cast("string") for f in rule.fields]))
        text = F.array_join(F.filter(said, lambda t: t != ""), "\n\n")
        return F.when(F.size(said) > 0, F.array(_turn(F.lit(rule.role), text))).otherwise(F.array().cast(TURNS))
    items = F.coalesce(F.col(f"`{rule.items}`"), F.array())
    if isinstance(rule, Alternate):
        return F.transform(items, lambda t, i: _turn(F.when(i % 2 == 0, rule.roles[0]).otherwise(rule.roles[1]), t))

    def turn(item: Column) -> Column:
        role = item[rule.role].cast("string")
        renamed = reduce(lambda other, pair: F.when(role == pair[0], pair[1]).otherwise(other), rule.names.items(), role)
        if "[]." in rule.text:
            parts, inner = rule.text.split("[].")
            return _turn(renamed, F.array_join(F.transform(item[parts], lambda part: part[inner]), ""))
        return _turn(renamed, item[rule.text])
    return F.transform(items, turn)


def canonical_turns(df: DataFrame, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """Conversations of any known layouts: (conv_id, layout, turns).

    A record whose fingerprint is unknown (also one without any value, unless the
    table has a row per turn) stays, with null ``layout`` and ``turns``. Null roles
    and texts read as empty. Rows of one ``conv_id`` follow by turn, then role, then
    text, nulls first; repeated rows are repeated turns. A row without ``conv_id`` is a
    conversation of its own, so that they make no common group. A table without the
    column ``conv_id`` has null ids. Columns that no layout names are not read.

    One conversation is one value and must fit a Spark string (2 GB).
    """
    there = set(paths_of(df))
    # A layout counts where the table's schema can hold it; that of a row per turn needs all of its columns.
    usable = [x for x in layouts if set(x.needed) <= there
              and (x.needed or set(x.optional) <= there)]
    by_layout: dict[str, list[str]] = {}
    for value, name in known_fingerprints(usable).items():
        by_layout.setdefault(name, []).append(value)
    found = df.withColumn("_print", fingerprint(df, layouts))
    layout = reduce(lambda other, x: F.when(F.col("_print").isin(by_layout[x.name]), x.name).otherwise(other),
                    usable, F.lit(None).cast("string"))
    found = found.withColumn("_layout", layout)
    key = F.col(ID) if ID in there else F.lit(None).cast("long")

    rows = [(x, x.turns[0]) for x in usable if isinstance(x.turns[0], Rows)]
    flat = [x for x in usable if not isinstance(x.turns[0], Rows)]

    def own_turns(x: Layout) -> Column:
        held = [r for r in x.turns if r is not SYSTEM or "system" in there]
        held = [Say(r.role, tuple(f for f in r.fields if f in there)) if isinstance(r, Say) else r for r in held]
        held = [r for r in held if not isinstance(r, Say) or r.fields]
        return F.concat(*[_turns(r).cast(TURNS) for r in held])

    turns = reduce(lambda other, x: F.when(F.col("_layout") == x.name, own_turns(x)).otherwise(other),
                   flat, F.lit(None).cast(TURNS))
    out = None
    if flat or not rows:
        records = found if not rows else found.filter(~F.col("_layout").eqNullSafe(rows[0][0].name))
        out = records.select(key.alias(ID), F.col("_layout").alias("layout"), turns.alias("turns"))
    for x, rule in rows:
        lone = F.when(key.isNull(), F.monotonically_increasing_id())
        turn = F.struct(F.col(f"`{rule.order}`").alias("at"), F.col(f"`{rule.role}`").cast("string").alias("role"),
                        F.col(f"`{rule.text}`").cast("string").alias("text"))
        grouped = (found.filter(F.col("_layout") == x.name).select(key.alias(ID), lone.alias("lone"), turn.alias("said"))
                   .groupBy(ID, "lone").agg(F.sort_array(F.collect_list("said")).alias("said"))
                   .select(ID, F.lit(x.name).alias("layout"),
                           F.transform("said", lambda t: _turn(t["role"], t["text"])).alias("turns")))
        out = grouped if out is None else out.unionByName(grouped)
    return out


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def format_chat(conversations: DataFrame) -> DataFrame:
    """Add ``formatted`` and ``loss_runs``, the mask of what is learned.

    The mask has an entry per turn, in UTF-8 bytes of ``formatted``: (before, learned,
    after). Exactly the texts of assistants are learned. No turns give the empty
    string; null turns give null.
    """
    parts = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(START), F.url_encode(t["role"]), F.lit("\n")).alias("head"),
        escape(t["text"]).alias("body"), (t["role"] == LEARNED).alias("learned")))
    tail = len(END) + 1
    runs = F.transform("_parts", lambda p: F.struct(
        F.when(p["learned"], F.octet_length(p["head"]))
        .otherwise(F.octet_length(p["head"]) + F.octet_length(p["body"]) + tail).alias("before"),
        F.when(p["learned"], F.octet_length(p["body"])).otherwise(0).alias("learned"),
        F.when(p["learned"], tail).otherwise(0).alias("after")))
    pieces = F.transform("_parts", lambda p: F.concat(p["head"], p["body"], F.lit(END + "\n")))
    return (conversations.withColumn("_parts", parts)
            .withColumns({"formatted": F.array_join(pieces, ""), "loss_runs": runs}).drop("_parts"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Replace ``turns`` by what ``formatted`` says; add ``learned``, the unescaped text under the mask."""
    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        first = F.length(role) + 2
        body = F.substr(piece, first, F.length(piece) - first + 1 - (len(END) + 1))
        return _turn(F.url_decode(role), unescape(body))

    pieces = F.split("formatted", START.replace("|", r"\|"), -1)
    pieces = F.slice(pieces, F.lit(2), F.size(pieces) - 1)
    learned = F.zip_with("_pieces", "loss_runs", lambda p, r: F.substring(
        F.concat(F.lit(START), p).cast("binary"), r["before"] + 1, r["learned"]).cast("string"))
    return (formatted.withColumn("_pieces", F.when(F.col("formatted").isNotNull(), pieces))
            .withColumns({"turns": F.transform("_pieces", turn),
                          "learned": F.array_join(F.transform(learned, unescape), "")}).drop("_pieces"))
