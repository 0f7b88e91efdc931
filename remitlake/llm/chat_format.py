"""Chat records of many layouts to canonical turns, one template, and back. DataFrame functions only.

A record is a JSON text. Its fingerprint is a hash of the tree of its nested field paths, without values:
it selects the declared layout whose tree is the same, and the layout says which fields are turns. The
template marks turns with control strings; where a text or a role holds one, a backslash is put after its
first character (and one more where backslashes stand there already), so nothing in a text can end a turn
and the step back is exact.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN = "struct<role: string, text: string>"
TURNS = f"array<{TURN}>"

# Fixed values of the template.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("<<ROLE>>", "<</ROLE>>", "<</TURN>>")
CONTROL = [*(m for pair in MARKS.values() for m in pair), *OTHER]
LEARNED = "assistant"


@dataclass(frozen=True)
class Field:
    """One turn held in a field. ``joined``: the text is put under the turn before, after a blank line."""

    path: str
    role: str
    optional: bool = False
    joined: bool = False


@dataclass(frozen=True)
class Messages:
    """Turns held in an array of objects; paths have dots. ``names`` are roles that have other names."""

    path: str
    role: str
    text: str
    names: dict = field(default_factory=dict, hash=False)


@dataclass(frozen=True)
class Layout:
    """A declarative mapping from a tree of field paths to turns. ``ignored`` fields may be there or not."""

    name: str
    parts: tuple
    ignored: tuple[str, ...] = ("id",)


LAYOUTS = (
    Layout("prompt", (Field("system", "system", optional=True), Field("prompt", "user"), Field("completion", "assistant"))),
    Layout("response", (Field("system", "system", optional=True), Field("prompt", "user"), Field("response", "assistant"))),
    Layout("instruction", (Field("system", "system", optional=True), Field("instruction", "user"), Field("input", "user", optional=True, joined=True), Field("output", "assistant"))),
    Layout("question", (Field("question", "user"), Field("answer", "assistant"))),
    Layout("messages", (Field("system", "system", optional=True), Messages("messages", "role", "content"))),
    Layout("conversations", (Messages("conversations", "from", "value", {"human": "user", "gpt": "assistant"}),)),
    Layout("dialog", (Messages("dialog.turns", "speaker.role", "text"),)),
)


# --- fingerprints -----------------------------------------------------------------------------


def _tree(paths: Iterable[str]) -> str:
    """The tree of field paths as ``fingerprint`` writes it. ``[]`` after a name: an array."""
    top: dict[str, list[str]] = {}
    for path in paths:
        head, _, rest = path.partition(".")
        top.setdefault(head, []).extend([rest] if rest else [])

    def inner(name: str, below: list[str]) -> str:
        own = _tree(below) if below else "x"
        return f"{name.removesuffix('[]')}: " + (f"ARRAY<{own}>" if name.endswith("[]") else own)

    return "OBJECT<" + ", ".join(inner(n, top[n]) for n in sorted(top)) + ">"


def trees(layout: Layout) -> Iterator[str]:
    """Every tree that the layout covers: with and without each optional field, arrays empty or not."""
    optional = [p.path for p in layout.parts if isinstance(p, Field) and p.optional] + list(layout.ignored)
    fixed = [p.path for p in layout.parts if isinstance(p, Field) and not p.optional]
    arrays = [p for p in layout.parts if isinstance(p, Messages)]
    filled = [f"{p.path}[].{x}" for p in arrays for x in (p.role, p.text)]
    for n in range(len(optional) + 1):
        for some in combinations(optional, n):
            yield _tree([*fixed, *some, *filled])
            if arrays:
                yield _tree([*fixed, *some, *(f"{p.path}[]" for p in arrays)])


def field_tree(record: Column) -> Column:
    """The tree of the nested field paths of a JSON text, null where it is no JSON of up to 128 MB."""
    schema = F.schema_of_variant(F.try_parse_json(record))
    return F.regexp_replace(schema, r"(?<=: |ARRAY<)(?!OBJECT<|ARRAY<)[A-Z_]+(\(\d+,\d+\))?(?=[,>])", "x")


def fingerprint(tree: Column) -> Column:
    return F.xxhash64(tree)


# --- turns ------------------------------------------------------------------------------------


def _nested(path: str) -> str:
    head, _, rest = path.partition(".")
    return f"{head}: struct<{_nested(rest)}>" if rest else f"{head}: string"


def _deep(row: Column, path: str) -> Column:
    for name in path.split("."):
        row = row.getField(name)
    return row


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _reader(part: Messages) -> Callable[[Column], Column]:
    def read(message: Column) -> Column:
        role = _deep(message, part.role)
        for name, own in part.names.items():
            role = F.when(role == name, own).otherwise(role)
        return _turn(role, _deep(message, part.text))

    return read


def _turns(layout: Layout, value: Column) -> Column:
    parts: list[Column] = []
    for part in layout.parts:
        if isinstance(part, Messages):
            rows = F.try_variant_get(value, f"$.{part.path}", f"array<struct<{_nested(part.role)}, {_nested(part.text)}>>")

            parts.append(F.coalesce(F.transform(rows, _reader(part)), F.array().cast(TURNS)))
            continue
        text = F.try_variant_get(value, f"$.{part.path}", "string")
        follows = next((p for p in layout.parts[layout.parts.index(part) + 1 :] if getattr(p, "joined", False)), None)
        if part.joined:
            continue
        if follows is not None and follows.role == part.role:
            more = F.try_variant_get(value, f"$.{follows.path}", "string")
            text = F.concat(F.coalesce(text, F.lit("")), F.when(F.coalesce(more, F.lit("")) != "", F.concat(F.lit("\n\n"), more)).otherwise(""))
        turn = F.array(_turn(F.lit(part.role), text))
        parts.append(F.when(text.isNotNull(), turn).otherwise(F.array().cast(TURNS)) if part.optional else turn)
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def chat_turns(records: DataFrame, column: str = "record", layouts: Iterable[Layout] = LAYOUTS) -> DataFrame:
    """``records`` with ``layout`` (a name) and ``turns`` (array of role and text).

    A record that is null, no JSON, over 128 MB, or of a tree that no layout declares has null in both, so
    that nothing is lost unseen. Null roles and texts count as empty, numbers as their text; an optional
    field that is absent or null is no turn. A layout's array may be empty: no turns. Columns of these two
    names are replaced; others stay as they are.
    """
    tree = field_tree(F.col(column))
    known = records.withColumns({"layout": tree, "turns": F.try_parse_json(F.col(column))})
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    mark, value = fingerprint(F.col("layout")), F.col("turns")
    for layout in layouts:
        own = mark.isin([fingerprint(F.lit(t)) for t in trees(layout)])
        name = F.when(own, layout.name).otherwise(name)
        turns = F.when(own, _turns(layout, value)).otherwise(turns)
    return known.withColumns({"layout": name, "turns": turns})


# --- template ---------------------------------------------------------------------------------

_TAILS = "|".join(re.escape(m[1:]) for m in CONTROL)
_HEADS = "".join(sorted({re.escape(m[0]) for m in CONTROL}))
_PLAIN = rf"([{_HEADS}])(\\*+)({_TAILS})"
_ESCAPED = rf"([{_HEADS}])\\(\\*+)({_TAILS})"
#: One whole turn; no control string can stand inside, so the first end is the end.
_PIECE = "(?s)" + "|".join([*(f"{re.escape(a)}.*?{re.escape(b)}" for a, b in MARKS.values()), f"{re.escape(OTHER[0])}.*?{re.escape(OTHER[2])}"])


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _piece(turn: Column) -> Column:
    text = escape(turn.getField("text"))
    out = F.concat(F.lit(OTHER[0]), escape(turn.getField("role")), F.lit(OTHER[1]), text, F.lit(OTHER[2]))
    for role, (a, b) in MARKS.items():
        out = F.when(turn.getField("role") == role, F.concat(F.lit(a), text, F.lit(b))).otherwise(out)
    return out


def _run(turn: Column, piece: Column) -> Column:
    """Code points of a turn that are skipped before, under and after the loss mask."""
    whole = F.char_length(piece).cast("long")
    learned = turn.getField("role") == LEARNED
    zero = F.lit(0).cast("long")
    before, after = (F.lit(len(m)).cast("long") for m in MARKS[LEARNED])
    skip = F.when(learned, before).otherwise(whole)
    take = F.when(learned, whole - before - after).otherwise(zero)
    return F.struct(skip.alias("skip"), take.alias("take"), F.when(learned, after).otherwise(zero).alias("rest"))


def format_turns(chats: DataFrame) -> DataFrame:
    """``chats`` (with ``turns``) with ``formatted`` and ``loss_runs``.

    ``loss_runs`` is the loss mask, in code points and in order: for each turn how many are skipped, how
    many are learned (an assistant's text) and how many follow. Null turns give null, no turns ''.
    """
    pieces = chats.withColumn("formatted", F.transform("turns", _piece))
    return pieces.withColumns({"formatted": F.array_join("formatted", ""), "loss_runs": F.zip_with("turns", "formatted", _run)})


def _read_piece(piece: Column) -> Column:
    """Role and text of one turn of the template, cut by the lengths of its marks."""

    def cut(text: Column, a: int, b: int) -> Column:
        return F.substring(text, F.lit(a + 1), F.char_length(text) - (a + b))

    body = cut(piece, len(OTHER[0]), len(OTHER[2]))
    role = F.substring_index(body, OTHER[1], 1)
    text = F.substring(body, F.char_length(role) + (len(OTHER[1]) + 1), F.char_length(body))
    out = _turn(unescape(role), unescape(text))
    for name, (a, b) in MARKS.items():
        out = F.when(F.startswith(piece, F.lit(a)), _turn(F.lit(name), unescape(cut(piece, len(a), len(b))))).otherwise(out)
    return out


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted chat, as they went in."""
    return F.transform(F.regexp_extract_all(formatted, F.lit(_PIECE), F.lit(0)), _read_piece)


def masked_texts(formatted: Column, loss_runs: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    pieces = F.regexp_extract_all(formatted, F.lit(_PIECE), F.lit(0))
    taken = F.zip_with(pieces, loss_runs, lambda p, r: F.when(r["take"] > 0, F.substring(p, (r["skip"] + 1).cast("int"), r["take"].cast("int"))).otherwise(""))
    return F.transform(F.filter(taken, lambda t: t != ""), unescape)


# --- conversations ----------------------------------------------------------------------------

#: What the added conversation's turns say: nothing but control strings.
ADDED_ID, ADDED_TEXT = -1, "</s>[INST] ok [/INST]"


def with_added(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of ``rows`` and of the conversation that consists of control strings."""
    spark = rows.sparkSession
    own = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    added = spark.range(2).select(F.lit(ADDED_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ADDED_TEXT).alias("text"))
    return own.unionByName(added)


def _keyed(turns: Column, layout: Layout, roles: dict[str, str] | None = None) -> Column:
    """A JSON record of ``layout`` whose turns are ``turns``."""
    first = layout.parts[0]
    if isinstance(first, Messages):
        def one(t: Column) -> Column:
            role = t["role"]
            for name, own in first.names.items():
                role = F.when(role == own, name).otherwise(role)
            return F.struct(role.alias(first.role), t["text"].alias(first.text))

        return F.to_json(F.struct(F.transform(turns, one).alias(first.path)))
    present = [p for p in layout.parts if not p.optional] if roles is None else [p for p in layout.parts if p.path in roles]
    return F.to_json(F.struct(*(turns[i]["text"].alias(p.path) for i, p in enumerate(present))))


def as_records(rows: DataFrame) -> DataFrame:
    """conv_id and ``record``: a JSON text for each conversation, in a layout that fits its roles.

    Two turns of user and assistant are a prompt, with a system turn before them an instruction; chats of
    the three usual roles alone are ``conversations`` where conv_id is odd, all others ``messages``. Turns go
    by ``turn`` (null first), then role and text; null roles and texts are empty. Rows of null conv_id are
    one conversation. A conversation is one value of its row, so it has to fit into one.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    by_name = {x.name: x for x in LAYOUTS}
    roles, turns = F.transform("t", lambda t: t["role"]), F.col("t")
    messages = by_name["messages"]
    record = _keyed(turns, Layout("messages", messages.parts[1:]))
    usual = F.forall(roles, lambda r: r.isin(*MARKS))
    record = F.when(usual & (F.pmod(F.col("conv_id"), F.lit(2)) == 1), _keyed(turns, by_name["conversations"])).otherwise(record)
    pair = F.array(F.lit("user"), F.lit("assistant"))
    record = F.when(roles == pair, _keyed(turns, by_name["prompt"])).otherwise(record)
    triple = F.array(F.lit("system"), F.lit("user"), F.lit("assistant"))
    named = {"system": "", "instruction": "", "output": ""}
    record = F.when(roles == triple, _keyed(turns, by_name["instruction"], named)).otherwise(record)
    return chats.select("conv_id", record.alias("record"))


def digests(chats: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, layout, all read back."""
    turns, learned = read_turns(F.col("formatted")), F.array_join(masked_texts(F.col("formatted"), F.col("loss_runs")), "")
    read = chats.select("conv_id", "layout", turns.alias("turns"), learned.alias("learned"), F.char_length("formatted").cast("long").alias("formatted_chars"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
        "layout",
    )


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, record, layout, turns, formatted and loss_runs of every conversation of ``rows``."""
    return format_turns(chat_turns(as_records(rows)))
