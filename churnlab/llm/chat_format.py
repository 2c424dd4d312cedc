"""Chat formatting: records of many layouts to canonical turns, then one template.

A record is a conversation in the layout of its source, as a VARIANT or as
JSON text.  Its schema fingerprint is a hash of its nested field paths
(``messages[].role``).  The distinct fingerprints are matched once against
declarative mappings (``LAYOUTS``): a mapping fits when every path that it
reads is there, the one that reads most wins.  The mapping then gives the
record's turns, a list of (role, text).

The template marks a turn as ``<|im_start|>role``, a line feed, the text,
``<|im_end|>`` and a line feed.  In roles and texts ``<`` followed by any number of
backslashes and ``|`` gets one backslash more, so that no text holds ``<|``
and every text can be read back.  The loss mask is a list of spans, one per
assistant text, in code points and in bytes.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import let, packed, running_sum, saved, unpacked

START, END = "<|im_start|>", "<|im_end|>"
LEARNT = "assistant"
#: Names that layouts of the from/value kind give to the roles.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
#: Objects and arrays that a path may pass through; what lies deeper does not tell layouts apart.
DEPTH = 6


class One(NamedTuple):
    """One turn of a fixed role; non-empty texts of several paths are parted by a blank line."""
    role: str
    texts: tuple[str, ...]


class Each(NamedTuple):
    """One turn for every element of the array at ``at``; the first of ``texts`` that an
    element has is its text (``content[].text``: that of all its parts, joined)."""
    at: str
    role: str
    texts: tuple[str, ...]
    names: dict[str, str] = {}


class Layout(NamedTuple):
    name: str
    turns: tuple[One | Each, ...]

    def paths(self) -> list[str]:
        """The field paths that the mapping reads."""
        found = []
        for t in self.turns:
            found += list(t.texts) if isinstance(t, One) else [f"{t.at}[].{p}" for p in (t.role, *t.texts)]
        return found


LAYOUTS = (
    Layout("messages", (Each("messages", "role", ("content",)),)),
    Layout("message_parts", (Each("messages", "role", ("content[].text",)),)),
    Layout("message_mixed", (Each("messages", "role", ("content[].text", "content")),)),
    Layout("conversations", (Each("conversations", "from", ("value",), ROLE_NAMES),)),
    Layout("dialogue", (Each("dialogue.turns", "speaker", ("utterance",), ROLE_NAMES),)),
    Layout("prompt_messages", (Each("prompt", "role", ("content",)), Each("completion", "role", ("content",)))),
    Layout("prompt_response", (One("user", ("prompt",)), One("assistant", ("response",)))),
    Layout("prompt_completion", (One("user", ("prompt",)), One("assistant", ("completion",)))),
    Layout("system_prompt_response", (One("system", ("system",)), One("user", ("prompt",)), One("assistant", ("response",)))),
    Layout("instruction_output", (One("user", ("instruction",)), One("assistant", ("output",)))),
    Layout("instruction_input_output", (One("user", ("instruction", "input")), One("assistant", ("output",)))),
    Layout("instruction_context_response", (One("user", ("instruction", "context")), One("assistant", ("response",)))),
    Layout("question_answer", (One("user", ("question.text",)), One("assistant", ("answer.text",)))),
)


# ---------------------------------------------------------------- fingerprints
def _key(name: Column) -> Column:
    """A field's name as a path step; names with other than word characters are quoted."""
    quoted = F.concat(F.lit("'"), name, F.lit("'"))
    return F.concat(F.lit("."), F.when(F.regexp_like(name, F.lit("^[A-Za-z0-9_-]+$")), name).otherwise(quoted))


def _children(node: Column) -> Column:
    """The nodes (path, value) one step below; of a leaf, the leaf without its value."""
    done = F.array(F.struct(node.path.alias("path"), F.lit(None).cast("variant").alias("value")))

    def of_items(items):
        below = F.transform(items, lambda x: F.struct(F.concat(node.path, F.lit("[]")).alias("path"), x.alias("value")))
        empty = F.array(F.struct(F.concat(node.path, F.lit("[]")).alias("path"), F.lit(None).cast("variant").alias("value")))
        return F.when(items.isNull(), done).when(F.size(items) == 0, empty).otherwise(below)

    def of_fields(fields):
        below = F.transform(F.map_entries(fields), lambda e: F.struct(
            F.concat(node.path, _key(e.key)).alias("path"), e.value.alias("value")))
        empty = F.array(F.struct(F.concat(node.path, F.lit(".")).alias("path"), F.lit(None).cast("variant").alias("value")))
        return F.when(fields.isNull(), let(F.try_variant_get(node.value, "$", "array<variant>"), of_items)).when(
            F.size(fields) == 0, empty).otherwise(below)

    return let(F.try_variant_get(node.value, "$", "map<string,variant>"), of_fields)


def field_paths(value: Column, depth: int = DEPTH) -> Column:
    """The paths of a variant's leaves, sorted, each once."""
    nodes = F.array(F.struct(F.lit("").alias("path"), value.alias("value")))
    for _ in range(depth):
        nodes = F.flatten(F.transform(nodes, _children))
    return F.array_sort(F.array_distinct(F.transform(nodes, lambda n: n.path)))


def choose_layout(paths: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """The name of the mapping that fits the paths and reads most of them; null where none fits."""
    ranked = sorted(layouts, key=lambda x: -len(x.paths()))
    fits = [F.when(F.size(F.array_except(F.array(*[F.lit("." + p) for p in x.paths()]), paths)) == 0, F.lit(x.name))
            for x in ranked]
    return F.coalesce(*fits)


# ----------------------------------------------------------------------- turns
def _text(value: Column, path: str) -> Column:
    if "[]." in path:
        at, inner = path.split("[].")
        parts = F.try_variant_get(value, f"$.{at}", "array<variant>")
        return F.array_join(F.transform(parts, lambda p: F.coalesce(
            F.try_variant_get(p, f"$.{inner}", "string"), F.lit(""))), "")
    return F.try_variant_get(value, f"$.{path}", "string")


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _element(each: Each):
    def turn(item):
        said = F.try_variant_get(item, f"$.{each.role}", "string")
        role = said
        for name, canonical in each.names.items():
            role = F.when(said == name, F.lit(canonical)).otherwise(role)
        return _turn(role, F.coalesce(*[_text(item, p) for p in each.texts]))
    return turn


def turns_of(record: Column, layout: Layout) -> Column:
    """The record's turns under one mapping."""
    found = []
    for t in layout.turns:
        if isinstance(t, One):
            texts = [F.coalesce(_text(record, p), F.lit("")) for p in t.texts]
            joined = texts[0] if len(texts) == 1 else F.array_join(F.array_remove(F.array(*texts), ""), "\n\n")
            found.append(F.array(_turn(F.lit(t.role), joined)))
            continue
        items = F.try_variant_get(record, f"$.{t.at}", "array<variant>")
        found.append(F.coalesce(F.transform(items, _element(t)), F.array().cast("array<struct<role:string,text:string>>")))
    return F.concat(*found)


# -------------------------------------------------------------------- template
def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def formatted(turns: Column) -> Column:
    """(text, spans, chars, bytes) of a list of turns: the formatted text, the
    loss mask and the formatted text's length."""
    def segment(t):
        return let(F.struct(F.concat(F.lit(START), _escaped_role(t.role), F.lit("\n")).alias("head"),
                            escaped(t.text).alias("body")), lambda s: F.struct(
            F.concat(s.head, s.body, F.lit(END + "\n")).alias("all"), (t.role == LEARNT).alias("learnt"),
            F.length(s.head).cast("long").alias("head"), F.length(s.body).cast("long").alias("body"),
            F.octet_length(s.head).cast("long").alias("head_bytes"),
            F.octet_length(s.body).cast("long").alias("body_bytes")))

    def whole(segments):
        tail = len(END) + 1
        sizes = F.transform(segments, lambda s: s.head + s.body + tail)
        byte_sizes = F.transform(segments, lambda s: s.head_bytes + s.body_bytes + tail)

        def spans(at):
            every = F.transform(segments, lambda s, i: F.struct(
                s.learnt.alias("learnt"), (F.get(at.chars, i) + s.head).alias("start"),
                (F.get(at.chars, i) + s.head + s.body).alias("end"),
                (F.get(at.bytes, i) + s.head_bytes).alias("byte_start"),
                (F.get(at.bytes, i) + s.head_bytes + s.body_bytes).alias("byte_end")))
            return F.transform(F.filter(every, lambda s: s.learnt), lambda s: F.struct(
                *[s[c].alias(c) for c in ("start", "end", "byte_start", "byte_end")]))

        def total(xs):
            return F.aggregate(xs, F.lit(0).cast("long"), lambda a, n: a + n)

        return F.struct(
            F.array_join(F.transform(segments, lambda s: s["all"]), "").alias("text"),
            let(F.struct(running_sum(sizes).alias("chars"), running_sum(byte_sizes).alias("bytes")), spans).alias("spans"),
            total(sizes).alias("chars"), total(byte_sizes).alias("bytes"))

    return let(F.transform(turns, segment), whole)


def format_chats(df: DataFrame, record_col: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Add ``fingerprint`` (long), ``layout``, ``n_turns``, ``formatted``,
    ``loss_spans``, ``chars`` and ``bytes`` to every row.

    ``record_col`` is a VARIANT or JSON text.  A null or unreadable record and
    one that no mapping fits have a null layout, no turns and an empty text.
    Null roles and texts are empty, other scalars their text.  Elements of
    ``loss_spans`` are (start, end, byte_start, byte_end), end exclusive, one
    per assistant turn, empty texts included.  Rows that repeat come back as
    often; input columns named like a result column are replaced.
    """
    new = ["fingerprint", "layout", "n_turns", "formatted", "loss_spans", "chars", "bytes"]
    record = F.col(f"`{record_col}`")
    if df.schema[record_col].dataType.typeName() == "string":
        record = F.try_parse_json(record)
    rows = packed(df.withColumn("__record", record), new).select(
        F.col("row").dropFields("__record").alias("row"), F.col("row.__record").alias("record"))
    rows = rows.withColumn("paths", field_paths(F.col("record")))
    rows = saved(rows.withColumn("fingerprint", F.xxhash64(F.array_join("paths", "\n"))), "chat-records")
    known = saved(rows.groupBy("fingerprint").agg(F.first("paths").alias("paths")).select(
        F.col("fingerprint").alias("known"), choose_layout(F.col("paths"), layouts).alias("layout")), "chat-layouts")
    rows = rows.join(known, F.col("fingerprint") == F.col("known"), "left")
    turns = F.array().cast("array<struct<role:string,text:string>>")
    for x in layouts:
        turns = F.when(F.col("layout") == x.name, turns_of(F.col("record"), x)).otherwise(turns)
    made = let(turns, lambda t: F.struct(F.size(t).cast("long").alias("n_turns"), formatted(t).alias("f")))
    rows = rows.select("row", "fingerprint", "layout", made.alias("made"))
    return unpacked(rows, "fingerprint", "layout", F.col("made.n_turns").alias("n_turns"), F.col("made.f.text").alias("formatted"),
                    F.col("made.f.spans").alias("loss_spans"), F.col("made.f.chars").alias("chars"),
                    F.col("made.f.bytes").alias("bytes"))


def assembled(parts: DataFrame, key: str, order: str) -> DataFrame:
    """(``key``, formatted, loss_spans, n_turns) of conversations that were
    formatted in parts; parts follow ``order``, a null first, spans move along.

    A conversation is one text in the end; but what is sorted and formatted at
    a time is a part, so that a very long one is not the work of one task.
    """
    part = F.struct(F.col(f"`{order}`").alias("order"), "formatted", "loss_spans", "n_turns", "chars", "bytes")
    listed = parts.groupBy(F.col(f"`{key}`").alias("key")).agg(F.array_sort(F.collect_list(part)).alias("parts"))

    def moved(at):
        return F.flatten(F.transform(F.col("parts"), lambda p, i: F.transform(p.loss_spans, lambda s: F.struct(
            (s.start + F.get(at.chars, i)).alias("start"), (s.end + F.get(at.chars, i)).alias("end"),
            (s.byte_start + F.get(at.bytes, i)).alias("byte_start"), (s.byte_end + F.get(at.bytes, i)).alias("byte_end")))))

    at = F.struct(running_sum(F.col("parts.chars")).alias("chars"), running_sum(F.col("parts.bytes")).alias("bytes"))
    return listed.select(
        F.col("key").alias(key), F.array_join("parts.formatted", "").alias("formatted"), let(at, moved).alias("loss_spans"),
        F.aggregate("parts.n_turns", F.lit(0).cast("long"), lambda a, n: a + n).alias("n_turns"))


# ---------------------------------------------------------------- reading back
def read_turns(text: Column) -> Column:
    """The turns that a formatted text holds."""
    pieces = F.split(text, "\\Q" + START + "\\E")
    return F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), lambda p: let(
        F.instr(p, F.lit("\n")), lambda cut: F.struct(
            _unescaped_role(F.substring(p, F.lit(1), cut - 1)).alias("role"),
            unescaped(F.substring(p, cut + 1, F.length(p) - cut - (len(END) + 1))).alias("text"))))


def read_learnt(text: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, joined."""
    def cut(data):
        return F.array_join(F.transform(spans, lambda s: unescaped(F.decode(F.substring(
            data, (s.byte_start + 1).cast("int"), (s.byte_end - s.byte_start).cast("int")), "UTF-8"))), "")

    return let(F.encode(text, "UTF-8"), cut)
