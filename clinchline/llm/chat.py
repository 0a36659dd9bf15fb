"""Chat formatting by schema fingerprints, with DataFrame functions only.

A record is a JSON object in one of several layouts. The nested field paths of all its parts, sorted
and hashed, are its schema fingerprint, which selects a declarative mapping to canonical turns (role, text).
Turns become one text under a template whose control strings are escaped inside roles and texts,
reversibly, with the spans of assistant texts as loss mask.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

#: The template: OPEN role SEP text CLOSE for every turn.
OPEN, SEP, CLOSE = "### ", ": ", "</turn>\n"
#: The role whose texts are learned.
LEARNED = "assistant"
#: A JSON value of so many bytes or more is no variant.
VARIANT_BYTES = 1 << 27
_TURNS = "array<struct<role: string, text: string>>"


@dataclass(frozen=True)
class Layout:
    """Field paths of a layout, and how its fields make turns.

    Either ``fields``: (role, top-level field) in the order of turns, or ``items``: the field that
    holds a list of messages, with the names of their role and text fields.
    """

    name: str
    paths: tuple[str, ...]
    fields: tuple[tuple[str, str], ...] = ()
    items: str = ""
    role: str = ""
    text: str = ""

    def turns(self, record: Column) -> Column:
        if self.items:
            schema = f"`{self.items}` array<struct<`{self.role}`: string, `{self.text}`: string>>"
            return F.transform(
                F.from_json(record, schema)[self.items],
                lambda m: F.struct(
                    F.coalesce(m[self.role], F.lit("")).alias("role"), F.coalesce(m[self.text], F.lit("")).alias("text")
                ),
            )
        schema = ", ".join(f"`{f}` string" for _, f in self.fields)
        parsed = F.from_json(record, schema)
        return F.array(
            *[F.struct(F.lit(r).alias("role"), F.coalesce(parsed[f], F.lit("")).alias("text")) for r, f in self.fields]
        )


LAYOUTS = (
    Layout("prompt", ("completion", "prompt"), fields=(("user", "prompt"), (LEARNED, "completion"))),
    Layout(
        "instruction",
        ("input", "instruction", "output"),
        fields=(("system", "instruction"), ("user", "input"), (LEARNED, "output")),
    ),
    Layout("question", ("answer", "question"), fields=(("user", "question"), (LEARNED, "answer"))),
    Layout("messages", ("messages", "messages.content", "messages.role"), items="messages", role="role", text="content"),
    Layout("shares", ("conversations", "conversations.from", "conversations.value"), items="conversations", role="from", text="value"),
)


def field_paths(record: Column) -> Column:
    """Sorted distinct field paths of a JSON object: its fields, and those of objects and of all objects in lists in them.

    What lies deeper adds its whole schema to its path, and an element of a list that is no object a path of
    the list, so that such records have other paths than plain ones. Texts that look like JSON are texts. Null
    for what is no JSON object, or repeats a field.
    """
    fields = lambda v: F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))

    def deeper(v: Column) -> Column:
        schema = F.schema_of_variant(v)
        return F.when(schema.rlike("^(OBJECT|ARRAY)<"), F.concat(F.lit(":"), schema)).otherwise("")

    none = F.array().cast("array<string>")

    def inner(k: Column, v: Column) -> Column:
        return F.transform(fields(v), lambda n: F.concat(k, F.lit("."), n["key"], deeper(n["value"])))

    def other(k: Column, v: Column) -> Column:
        return F.when(F.schema_of_variant(v) != "VOID", F.array(F.concat(k, F.lit("[]"), deeper(v)))).otherwise(none)

    def nested(k: Column, v: Column) -> Column:
        # distinct per list, so what is held of a long one are its few paths
        items = F.transform(
            F.try_variant_get(v, "$", "array<variant>"), lambda o: F.coalesce(inner(k, o), other(k, o))
        )
        return F.coalesce(F.array_distinct(F.flatten(items)), inner(k, v), none)

    each = F.transform(fields(F.try_parse_json(record)), lambda e: F.concat(F.array(e["key"]), nested(e["key"], e["value"])))
    found = F.coalesce(F.flatten(each), F.when(F.octet_length(record) >= VARIANT_BYTES, _long_paths(record)))
    return F.array_sort(F.array_distinct(found))


def _long_paths(record: Column) -> Column:
    """Field paths of a record too long for a variant: fields, and those of objects and of all objects in lists in them."""
    at = lambda k: F.call_function("get_json_object", record, F.concat(F.lit("$['"), k, F.lit("']")))
    none = F.array().cast("array<string>")
    inner = lambda k: F.flatten(
        F.transform(F.from_json(at(k), "array<map<string,string>>"), lambda m: F.coalesce(F.map_keys(m), none))
    )
    return F.flatten(
        F.transform(
            F.json_object_keys(record),
            lambda k: F.concat(F.array(k), F.transform(F.coalesce(F.array_distinct(inner(k)), none), lambda n: F.concat(k, F.lit("."), n))),
        )
    )


def fingerprint_of(paths: Column) -> Column:
    return F.sha2(F.array_join(paths, "\n"), 256)


def escape(text: Column) -> Column:
    """Control strings cannot occur in the result: every ``#`` and ``</turn>`` is broken up."""
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("#"), F.lit("\\#"))
    return F.replace(out, F.lit("</turn>"), F.lit("<\\/turn>"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\c"))


def unescape(text: Column) -> Column:
    """The inverse of ``escape`` and ``escape_role``: pairs of backslashes are read from the left."""
    plain = lambda p: F.replace(F.replace(F.replace(p, F.lit("\\#"), F.lit("#")), F.lit("\\/"), F.lit("/")), F.lit("\\c"), F.lit(":"))
    return F.when(text.contains("\\"), F.array_join(F.transform(F.split(text, r"\\\\"), plain), "\\")).otherwise(text)


def canonical_turns(records: DataFrame, record_col: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``records`` with ``fingerprint``, ``layout`` and ``turns`` array<struct<role, text>>.

    The fingerprint of a record selects its layout; a record that is null, no JSON object or of an
    unknown layout has a null layout and null turns and stays. Missing roles and texts are empty.
    Columns of these names in the input are replaced; all others are kept.
    """
    print_ = fingerprint_of(field_paths(F.col(record_col)))
    found = records.withColumn("fingerprint", print_)
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(_TURNS)
    for layout in layouts:
        own = F.col("fingerprint") == fingerprint_of(F.array(*[F.lit(p) for p in sorted(layout.paths)]))
        name = F.when(own, F.lit(layout.name)).otherwise(name)
        turns = F.when(own, layout.turns(F.col(record_col))).otherwise(turns)
    return found.withColumns({"layout": name, "turns": turns})


def format_chats(records: DataFrame, record_col: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``canonical_turns`` with ``formatted`` and ``loss_spans`` array<struct<start, end>>.

    Spans are code points of ``formatted`` that hold the escaped texts of assistant turns. A record
    without turns is formatted as the empty text; one without a layout as null.
    """
    pieces = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit(SEP)).alias("head"),
            escape(t["text"]).alias("body"),
            (t["role"] == LEARNED).alias("learned"),
        ),
    )
    sized = F.transform(
        "pieces",
        lambda p: F.struct(
            (F.length(p["head"]) + F.length(p["body"]) + len(CLOSE)).alias("size"),
            F.length(p["head"]).alias("head"),
            F.length(p["body"]).alias("body"),
            p["learned"].alias("learned"),
        ),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, end: int>>").alias("spans"))
    walked = F.aggregate(
        "sized",
        start,
        lambda acc, p: F.struct(
            (acc["at"] + p["size"]).alias("at"),
            F.when(
                p["learned"],
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + p["head"]).alias("start"), (acc["at"] + p["head"] + p["body"]).alias("end")
                        )
                    ),
                ),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return (
        canonical_turns(records, record_col, layouts)
        .withColumn("pieces", pieces)
        .withColumn("sized", sized)
        .withColumn("formatted", F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), ""))
        .withColumn("loss_spans", walked)
        .drop("pieces", "sized")
    )


def read_chats(formatted: Column) -> Column:
    """The turns of a formatted text, unescaped."""
    parts = F.filter(F.split(formatted, CLOSE), lambda p: p != "")
    return F.transform(
        parts,
        lambda p: F.struct(
            unescape(F.substring_index(p.substr(F.lit(len(OPEN) + 1), F.length(p)), SEP, 1)).alias("role"),
            unescape(_after(p)).alias("text"),
        ),
    )


def _after(piece: Column) -> Column:
    """What follows the first separator of a piece; roles hold no colon."""
    return piece.substr(F.instr(piece, SEP) + len(SEP), F.length(piece))


def learned_texts(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask."""
    return F.transform(spans, lambda s: unescape(formatted.substr(s["start"] + 1, s["end"] - s["start"])))


def records_of_rows(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """One JSON record per conversation of a table of turns, in the simplest layout that holds it.

    Turns are ordered by number, then role and text; nulls first. A user and an assistant turn make
    a prompt record, a system, user and assistant turn an instruction record, others messages. A
    conversation is one record and so is put together in one place, whatever its number of turns.
    """
    ordered = F.array_sort(
        F.collect_list(
            F.struct(
                F.coalesce(F.col(turn_col).cast("long"), F.lit(-(2**63))).alias("turn"),
                F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                F.coalesce(F.col(text_col), F.lit("")).alias("content"),
            )
        )
    )
    text = lambda i: F.col("m")[i]["content"]
    roles = F.transform("m", lambda x: x["role"])
    is_ = lambda *names: roles == F.array(*[F.lit(x) for x in names])
    return (
        rows.groupBy(F.col(conv_col).alias("conv_id"))
        .agg(ordered.alias("m"))
        .select(
            "conv_id",
            F.when(is_("user", LEARNED), F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("completion"))))
            .when(
                is_("system", "user", LEARNED),
                F.to_json(F.struct(text(0).alias("instruction"), text(1).alias("input"), text(2).alias("output"))),
            )
            .otherwise(
                F.to_json(
                    F.struct(F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))
                )
            )
            .alias("record"),
        )
    )
