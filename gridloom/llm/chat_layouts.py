"""Chat formatting: layouts recognised by a fingerprint of their field paths, turned into canonical turns.

A fingerprint is the hash of sorted field paths (``messages[].role``) of a schema, of a frame as a
whole or of each JSON record: of those paths that a layout maps, so further fields do not
count. It selects a declarative mapping to canonical turns, ``array<struct<role, text>>``; where
several layouts fit, the first of ``LAYOUTS``. Rows that are one turn each are a layout too. The
template writes the turns as one string with the spans that carry loss, and reads them back.

Template: each turn is ``<s>`` + marker + text + ``</s>``; markers are ``[INST] `` (user),
``[/INST] `` (assistant), ``<<SYS>> `` (system) and ``[ROLE]name[/ROLE] `` (any other role).
Inside texts a backslash is doubled and a control string gets a backslash after its first
character, so that no control string is left; reading drops one backslash of each pair.

Cases: a null text is empty and a null role is the empty role. Texts of any length are written
whole. Turn rows without a
conversation id are conversations of their own. Rows of equal turn number are ordered by
role, then text; repeated rows are repeated turns. A record of no known layout, or that is
no JSON, keeps its row with a null layout and no turns. An empty table gives an empty table.
Only the mapped columns of a frame are read, so further columns may have any name.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.common import bound, free_name

ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}
MARKERS = {"user": "[INST] ", "assistant": "[/INST] ", "system": "<<SYS>> "}
OPEN, CLOSE = "<s>", "</s>"
CONTROL = r"([<\[])(/?s>|/?INST\]|<SYS>>|/?ROLE\])"


@dataclass(frozen=True)
class Layout:
    """``paths`` must be there, ``optional`` may be; ``listed`` names an array of (role, text) records.

    Without ``listed``, ``parts`` gives each turn's role and the fields whose texts are joined by a blank line.
    With ``rows`` each row is one turn.
    """

    name: str
    paths: tuple[str, ...]
    optional: tuple[str, ...] = ()
    listed: tuple[str, str, str] | None = None
    parts: tuple[tuple[str, tuple[str, ...]], ...] = ()
    rows: bool = False

    @property
    def mapped(self) -> tuple[str, ...]:
        return self.paths + self.optional


LAYOUTS = (
    Layout("turn rows", ("conv_id", "role", "text", "turn"), rows=True),
    Layout("messages", ("messages[].content", "messages[].role"), listed=("messages", "role", "content")),
    Layout("from and value", ("conversations[].from", "conversations[].value"),
           listed=("conversations", "from", "value")),
    Layout("instruction", ("instruction", "output"), ("input", "system"),
           parts=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("prompt and completion", ("completion", "prompt"), ("system",),
           parts=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt and response", ("prompt", "response"), ("system",),
           parts=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("question and answer", ("answer", "question"), ("context",),
           parts=(("user", ("context", "question")), ("assistant", ("answer",)))),
)


def fingerprint(paths) -> str:
    """Hash of a set of field paths."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


def field_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Paths of all leaves of a schema; ``[]`` steps into an array."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, at + "[]")
    return [at]


def _fingerprints(layout: Layout) -> dict[str, tuple[str, ...]]:
    """A fingerprint for each choice of the optional fields, with the fields of that choice."""
    chosen = [()]
    for name in layout.optional:
        chosen += [c + (name,) for c in chosen]
    return {fingerprint(layout.paths + c): layout.paths + c for c in chosen}


KNOWN: dict[str, tuple[Layout, tuple[str, ...]]] = {
    f: (layout, fields) for layout in LAYOUTS for f, fields in _fingerprints(layout).items()}


def selected(present: set[str]) -> tuple[Layout, tuple[str, ...]] | None:
    """The layout whose fingerprint the present paths have, and its fields."""
    for layout in LAYOUTS:
        known = KNOWN.get(fingerprint(p for p in layout.mapped if p in present))
        if known and known[0] is layout:
            return known
    return None


def _turn(role: Column, text: Column) -> Column:
    role = F.coalesce(role, F.lit(""))
    for old, new in ROLE_NAMES.items():
        role = F.when(role == old, F.lit(new)).otherwise(role)
    return F.struct(role.alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _mapped(layout: Layout, fields: tuple[str, ...], get) -> Column:
    """Canonical turns; ``get(path, type)`` gives a field of the record."""
    if layout.listed:
        array, role, text = layout.listed
        items = get(array, f"array<struct<`{role}` string, `{text}` string>>")
        return F.transform(items, lambda x: _turn(x[role], x[text]))
    turns = []
    for role, names in layout.parts:
        have = [get(n, "string") for n in names if n in fields]
        if have:
            filled = F.filter(F.array(*have), lambda x: F.coalesce(x, F.lit("")) != "")
            text = F.array_join(filled, "\n\n")
            optional = set(names) <= set(layout.optional)
            turns.append(F.when((text == "") & F.lit(optional), F.lit(None)).otherwise(_turn(F.lit(role), text)))
    return F.filter(F.array(*turns), lambda x: x.isNotNull())


def record_paths(record: Column) -> Column:
    """Sorted field paths of a variant."""
    schema = F.schema_of_variant(record)
    # leaf types say nothing about the layout: only names and nesting stay
    bare = F.regexp_replace(schema, r": (?!ARRAY<|OBJECT<)[A-Z]+(?:\([0-9,]+\))?", "")
    flat = F.regexp_replace(bare, r"^OBJECT<|>$", "")
    item = F.regexp_replace(flat, r"`", "")
    fields = F.filter(F.split(item, r", (?![^<]*>)"), lambda x: x != "")

    def opened(x: Column) -> Column:
        name = F.regexp_extract(x, r"^([^:]+): ARRAY<OBJECT<", 1)
        inner = F.split(F.regexp_extract(x, r"^[^:]+: ARRAY<OBJECT<(.*)>>$", 1), ", ")
        return F.when(name != "", F.transform(inner, lambda y: F.concat(name, F.lit("[]."), y))) \
            .otherwise(F.array(F.regexp_replace(x, r": .*", "[]")))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(fields, opened))))


def turns_of_records(frame: DataFrame, record: str = "record", layout: str = "layout",
                     turns: str = "turns") -> DataFrame:
    """Rows of JSON texts in mixed layouts, with the layout's name and the canonical turns."""
    parsed = F.try_parse_json(F.col(f"`{record}`"))
    whole = [kind for kind in LAYOUTS if not kind.rows]  # a record is a whole conversation

    def mark(paths: Column, mapped: list[str]) -> Column:
        return F.sha2(F.array_join(F.filter(paths, lambda p: p.isin(mapped)), "\n"), 256)

    def marks(paths: Column) -> Column:
        return F.array(*[mark(paths, list(kind.mapped)) for kind in whole])

    held = free_name(frame, "layout_marks")
    marked = frame.withColumn(held, bound(record_paths(parsed), marks))
    name, value = F.lit(None).cast("string"), F.array().cast("array<struct<role:string,text:string>>")
    for i, kind in reversed(list(enumerate(whole))):  # the first layout that fits is asked last
        for known, fields in ((k, f) for k, (of, f) in KNOWN.items() if of is kind):
            def get(path: str, type_name: str) -> Column:
                return F.try_variant_get(parsed, f"$.{path}", type_name)
            mine = F.get(F.col(held), F.lit(i)) == known
            name = F.when(mine, F.lit(kind.name)).otherwise(name)
            value = F.when(mine, _mapped(kind, fields, get)).otherwise(value)
    return marked.withColumn(layout, name).withColumn(
        turns, F.coalesce(value, F.array().cast("array<struct<role:string,text:string>>"))).drop(held)


def turns_of_frame(frame: DataFrame) -> DataFrame:
    """A frame in one known layout, or of turn rows, as canonical turns.

    Turn rows give ``conv_id, turns``; a frame of records keeps its columns and gets ``turns``.
    Columns beside those of the layout do not count.
    """
    present = set(field_paths(frame.schema))
    found = selected(present)
    if found is None:
        raise ValueError(f"no layout has the fields {sorted(present)}")
    kind, fields = found
    if kind.rows:
        return _grouped(frame.select(*fields))
    return frame.withColumn("turns", _mapped(
        kind, fields, lambda p, t: F.col(p) if t.startswith("array") else F.col(p).cast(t)))


def _grouped(rows: DataFrame) -> DataFrame:
    own = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    one = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = rows.select("conv_id", own.alias("own"), one.alias("one")) \
        .groupBy("conv_id", "own").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    # roles of turn rows are canonical as they are
    return grouped.select("conv_id", F.transform("turns", lambda x: x.dropFields("turn")).alias("turns"))


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), CONTROL, r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted(turns: Column) -> Column:
    """``struct<text, loss>``: the formatted string and the spans (start, length in code points) under loss."""
    def marker(role: Column) -> Column:
        mark = F.concat(F.lit("[ROLE]"), escaped(role), F.lit("[/ROLE] "))
        for name, text in MARKERS.items():
            mark = F.when(role == name, F.lit(text)).otherwise(mark)
        return F.concat(F.lit(OPEN), mark)

    pieces = F.transform(turns, lambda t: F.struct(
        marker(t["role"]).alias("head"), escaped(t["text"]).alias("body"), (t["role"] == "assistant").alias("loss")))

    def step(seen: Column, p: Column) -> Column:
        start = seen["at"] + F.length(p["head"])
        end = start + F.length(p["body"])
        span = F.array(F.struct(start.alias("start"), (end - start).alias("length")))
        return F.struct((end + len(CLOSE)).alias("at"),
                        F.when(p["loss"], F.concat(seen["spans"], span)).otherwise(seen["spans"]).alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def written(p: Column) -> Column:
        text = F.array_join(F.transform(p, lambda x: F.concat(x["head"], x["body"], F.lit(CLOSE))), "")
        return F.struct(text.alias("text"), F.aggregate(p, begin, step, lambda s: s["spans"]).alias("loss"))

    return bound(pieces, written)


def read_turns(text: Column) -> Column:
    """The canonical turns of a formatted string."""
    def turn(x: Column) -> Column:
        other = r"(?s)^\[ROLE\](.*?)\[/ROLE\] "
        role, body = F.regexp_extract(x, other, 1), F.regexp_replace(x, other, "")
        for name, mark in MARKERS.items():
            mine = x.startswith(mark)
            role = F.when(mine, F.lit(name)).otherwise(role)
            body = F.when(mine, F.substr(x, F.lit(len(mark) + 1))).otherwise(body)
        return F.struct(unescaped(role).alias("role"), unescaped(body).alias("text"))

    parts = F.split(text, CLOSE)
    whole = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.transform(whole, lambda x: turn(F.substr(x, F.lit(len(OPEN) + 1))))


def loss_texts(text: Column, spans: Column) -> Column:
    """The unescaped texts under the loss spans."""
    return F.transform(spans, lambda s: unescaped(F.substr(text, s["start"] + 1, s["length"])))


def format_chats(frame: DataFrame) -> DataFrame:
    """``conv_id, text, loss`` of turn rows, or the frame's columns with ``text`` and ``loss``."""
    made = turns_of_frame(frame)
    keep = [F.col(f"`{c}`") for c in made.columns if c not in ("turns", "text", "loss")]
    return made.select(*keep, formatted(F.col("turns")).alias("made")).select(*keep, "made.text", "made.loss")
