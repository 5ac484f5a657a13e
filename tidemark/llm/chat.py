"""Chat formatting: schema fingerprints select declarative mappings to canonical turns.

A record is a variant.  The paths of its nested fields are hashed; the hash is
looked up among the fingerprints of the declared layouts, and the layout found
says where roles and texts lie.  A template then marks the turns, escapes
control strings inside texts reversibly and tells which characters carry loss.

Defined results: a null or unparsable record, or one of an unknown layout, has
null turns and its fingerprint for a report; a null text or role is empty; a
conversation without turns formats to an empty text; turns with equal numbers
are ordered by role and text; repeated rows are repeated turns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh

TURNS = "array<struct<role:string,text:string>>"
ROOT_PATH = "$"
_STEP = "struct<stack:array<string>,paths:array<string>>"


@dataclass(frozen=True)
class Field:
    """One turn: a fixed role, and the path of its text; an absent or null text gives no turn."""

    role: str
    text: str


@dataclass(frozen=True)
class Layout:
    """Either a list of turns (``each`` with names of role and text) or ``fields`` in order.

    ``optional`` fields may be missing; ``roles`` renames roles.
    """

    name: str
    each: str = ""
    role: str = "role"
    text: str = "text"
    fields: tuple[Field, ...] = ()
    optional: tuple[str, ...] = ()
    roles: tuple[tuple[str, str], ...] = ()

    def path_sets(self) -> list[frozenset[str]]:
        """The sets of field paths that records of this layout can have."""
        if self.each:
            return [frozenset({f"{self.each}[].{self.role}", f"{self.each}[].{self.text}"}), frozenset({f"{self.each}[]"})]
        sets = [frozenset(f.text for f in self.fields if f.text not in self.optional)]
        for name in self.optional:
            sets += [s | {name} for s in sets]
        return sets

    def turns(self, record: Column) -> Column:
        if self.each:
            kind = f"array<struct<`{self.role}`:string,`{self.text}`:string>>"
            listed = F.try_variant_get(record, f"$.{self.each}", kind)
            return F.transform(
                listed,
                lambda t: F.struct(self._renamed(F.coalesce(t[self.role], F.lit(""))).alias("role"), F.coalesce(t[self.text], F.lit("")).alias("text")),
            )
        texts = [(f.role, F.try_variant_get(record, f"$.{f.text}", "string"), f.text in self.optional) for f in self.fields]
        given = [
            F.when(F.lit(not optional) | text.isNotNull(), F.struct(F.lit(role).alias("role"), F.coalesce(text, F.lit("")).alias("text")))
            for role, text, optional in texts
        ]
        return F.filter(F.array(*given), lambda t: t.isNotNull())

    def _renamed(self, role: Column) -> Column:
        for old, new in self.roles:
            role = F.when(role == old, new).otherwise(role)
        return role


LAYOUTS = (
    Layout("messages", each="messages", role="role", text="content"),
    Layout("messages_text", each="messages", role="role", text="text"),
    Layout(
        "conversations",
        each="conversations",
        role="from",
        text="value",
        roles=(("human", "user"), ("gpt", "assistant")),
    ),
    Layout(
        "prompt_response",
        fields=(Field("system", "system"), Field("user", "prompt"), Field("assistant", "response")),
        optional=("system",),
    ),
    Layout("prompt_completion", fields=(Field("user", "prompt"), Field("assistant", "completion"))),
    Layout(
        "instruction",
        fields=(Field("system", "input"), Field("user", "instruction"), Field("assistant", "output")),
        optional=("input",),
    ),
)

# control strings of the template, and of other common templates that texts must not smuggle in
CONTROL = r"/?s>|/?SYS>|/?INST\]|/?ROLE\]|\|(?:im_start|im_end|endoftext|user|assistant|system)\|>"
_ESCAPE = rf"([<\[])(\\*)({CONTROL})"
_UNESCAPE = rf"([<\[])\\(\\*)({CONTROL})"
# turns of a conversation that are measured and cut at a time
BLOCK = 256
BEGIN, ROLE, END_ROLE, END = "<s>", "[ROLE]", "[/ROLE]\n", "</s>\n"


def field_paths(record: Column) -> Column:
    """The sorted, distinct paths of a variant's leaf fields; ``[]`` stands for list elements.

    The variant's own schema text is read from left to right with a stack of
    open names.
    """
    schema = F.schema_of_variant(record)
    token = r"(?:(?:`(?:[^`]|``)*`|[^\s<>,:`]+): )?(?:OBJECT<|ARRAY<)|>|(?:(?:`(?:[^`]|``)*`|[^\s<>,:`]+): )?[A-Z][A-Z_]*(?:\([0-9,]*\))?"
    tokens = F.regexp_extract_all(schema, F.lit(f"({token})"), F.lit(1))

    def read(state: Column, part: Column) -> Column:
        stack, paths = state["stack"], state["paths"]
        name = F.regexp_extract(part, r"^(.*): ", 1)
        top = F.coalesce(F.get(stack, F.size(stack) - 1), F.lit(""))
        here = F.when(name == "", top).when(top == "", name).otherwise(F.concat(top, F.lit("."), name))
        opened = F.when(part.endswith("OBJECT<"), here).when(part.endswith("ARRAY<"), F.concat(here, F.lit("[]")))
        return (
            F.when(part == ">", F.struct(F.slice(stack, F.lit(1), F.greatest(F.lit(0), F.size(stack) - 1)).alias("stack"), paths.alias("paths")))
            .when(opened.isNotNull(), F.struct(F.array_append(stack, opened).alias("stack"), paths.alias("paths")))
            .otherwise(F.struct(stack.alias("stack"), F.array_append(paths, here).alias("paths")))
            .cast(_STEP)
        )

    empty = F.array().cast("array<string>")
    start = F.struct(empty.alias("stack"), empty.alias("paths")).cast(_STEP)
    return F.array_sort(F.array_distinct(F.aggregate(tokens, start, read)["paths"]))


def fingerprint(paths: Column) -> Column:
    return F.sha2(F.array_join(paths, "\n"), 256)


def _layout_name(paths: Column, layouts: tuple[Layout, ...]) -> Column:
    """The layout whose fingerprint the record has; the choice is among declared layouts only."""
    import hashlib

    found, print_of = F.lit(None).cast("string"), fingerprint(paths)
    for layout in reversed(layouts):
        known = [hashlib.sha256("\n".join(sorted(s)).encode()).hexdigest() for s in layout.path_sets()]
        found = F.when(print_of.isin(known), layout.name).otherwise(found)
    return found


def canonical_turns(records: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``records`` with ``fingerprint``, ``layout`` (null if unknown) and ``turns``.

    Columns of these names are replaced; any others pass through.
    """
    paths = fresh(records, "_paths")
    named = records.withColumn(paths, field_paths(F.col(record)))
    named = named.withColumn("fingerprint", fingerprint(F.col(paths))).withColumn("layout", _layout_name(F.col(paths), layouts))
    turns = F.lit(None).cast(TURNS)
    for layout in layouts:
        turns = F.when(F.col("layout") == layout.name, layout.turns(F.col(record))).otherwise(turns)
    return named.withColumn("turns", turns).drop(paths)


def escape(text: Column) -> Column:
    """One more backslash inside each control string, so that none is left."""
    return F.regexp_replace(text, F.lit(_ESCAPE), F.lit(r"$1\\$2$3"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_UNESCAPE), F.lit("$1$2$3"))


def _blocks(items: Column) -> Column:
    """``items`` in blocks of ``BLOCK``; the last may be empty.

    Work that grows with the square of a list's length, as appending and counting
    characters from a text's start do, is done within blocks and across them.
    """
    numbers = F.sequence(F.lit(0), (F.size(items) / BLOCK).cast("int"))
    return F.when(items.isNotNull(), F.transform(numbers, lambda i: F.slice(items, i * BLOCK + 1, F.lit(BLOCK))))


def _with_spans(df: DataFrame, sizes: Column, name: str) -> DataFrame:
    """Add the spans of the parts that carry loss, given each part's ``head``, ``body`` and ``loss``."""
    local, starts, found = (fresh(df, n) for n in ("_local", "_starts", "_found"))
    kind = "struct<at:bigint,spans:array<struct<start:bigint,end:bigint>>>"

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + part["head"]
        end = start + part["body"]
        spans = F.when(part["loss"], F.array_append(state["spans"], F.struct(start.alias("start"), end.alias("end"))))
        return F.struct((end + len(END)).alias("at"), F.coalesce(spans, state["spans"]).alias("spans")).cast(kind)

    def following(known: Column, block: Column) -> Column:
        return F.array_append(known, F.element_at(known, -1) + block["at"])

    def shifted(block: Column, place: Column) -> Column:
        start = F.get(F.col(starts), place)
        return F.transform(block["spans"], lambda s: F.struct((start + s["start"]).alias("start"), (start + s["end"]).alias("end")))

    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")).cast(kind)
    first = F.array(F.lit(0).cast("long"))
    sized = df.withColumn(found, sizes)
    walked = sized.withColumn(local, F.transform(_blocks(F.col(found)), lambda block: F.aggregate(block, begin, step)))
    placed = walked.withColumn(starts, F.aggregate(local, first, following))
    return placed.withColumn(name, F.flatten(F.transform(local, shifted))).drop(local, starts, found)


def formatted(canonical: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Adds ``formatted`` and ``loss_spans`` (start and end in code points of the texts that carry loss).

    Columns of these names are replaced; any others pass through.
    """
    parts = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(BEGIN + ROLE), escape(t["role"]), F.lit(END_ROLE)).alias("head"),
            escape(t["text"]).alias("body"),
            (t["role"] == loss_role).alias("loss"),
        ),
    )
    name = fresh(canonical, "_parts")
    marked = F.array_join(F.transform(name, lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    sizes = F.transform(
        name, lambda p: F.struct(F.length(p["head"]).alias("head"), F.length(p["body"]).alias("body"), p["loss"].alias("loss"))
    )
    return _with_spans(canonical.withColumn(name, parts).withColumn("formatted", marked), sizes, "loss_spans").drop(name)


def read_back(column: str = "formatted") -> Column:
    """The turns of a formatted text; the marks cannot occur inside escaped roles and texts."""
    pieces = F.filter(F.split(column, BEGIN), lambda p: p != "")

    def turn(piece: Column) -> Column:
        # the head ends at the first end mark: by its length, as a role may hold line feeds at either end
        role = F.substring_index(F.substr(piece, F.lit(len(ROLE) + 1)), END_ROLE, 1)
        head = len(ROLE) + len(END_ROLE)
        body = F.substr(piece, F.length(role) + head + 1, F.length(piece) - F.length(role) - head - len(END))
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))

    return F.transform(pieces, turn)


def read_loss(formatted_column: str = "formatted", spans: str = "loss_spans") -> Column:
    """The unescaped text under the loss mask."""

    def cut(text: Column, start: Column, end: Column) -> Column:
        return F.substr(text, (start + 1).cast("int"), (end - start).cast("int"))

    def stretch(block: Column) -> Column:
        first, last = F.get(block, F.lit(0))["start"], F.get(block, F.size(block) - 1)["end"]
        return F.struct(block.alias("spans"), first.alias("first"), cut(F.col(formatted_column), first, last).alias("text"))

    def told(block: Column) -> Column:
        first = block["first"]
        return F.array_join(F.transform(block["spans"], lambda s: unescape(cut(block["text"], s["start"] - first, s["end"] - first))), "")

    return F.array_join(F.transform(F.transform(_blocks(F.col(spans)), stretch), told), "")


def records_of_turns(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows by turn as one record per conversation, of the layout ``messages_text``.

    A conversation is one output text, so its rows have to meet; different
    conversations are spread by their ids.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))))
    grouped = rows.groupBy(F.col(conv_id).alias("conv_id")).agg(ordered.alias("_turns"))
    messages = F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return grouped.select("conv_id", F.to_variant_object(F.struct(messages.alias("messages"))).alias("record"))
