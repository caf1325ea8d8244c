"""Chat formatting: records of any known layout become canonical turns, then one text.

A record is JSON.  Its nested field paths are hashed to a fingerprint, which
selects a declarative mapping from the layout to turns.  Turns are written as

    <s>role[INST]text[/INST]</s>

and the four control strings are escaped inside roles and texts, so the formatted
text can be parsed back exactly.  Everything is built-in column functions.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ASSISTANT = "assistant"


@dataclass(frozen=True)
class Layout:
    """Field paths of a layout and where its turns are.

    ``paths`` is the record's shape as written by :func:`shape`.  ``turns`` lists
    (role, JSON path) in order, the role a name or a path; with ``each``, turns are the elements of an array
    of (role field, text field) and ``roles`` renames roles.
    """

    name: str
    paths: str
    turns: tuple[tuple[str, str], ...] = ()
    each: tuple[str, str, str] | None = None
    roles: tuple[tuple[str, str], ...] = ()

    @property
    def fingerprint(self) -> str:
        return hashlib.sha256(self.paths.encode()).hexdigest()

    def canonical(self, record: Column) -> Column:
        """The record's turns as an array of (role, text)."""
        if self.each is None:
            return F.array(*(_turn(_said_by(record, r), F.variant_get(record, p, "string")) for r, p in self.turns))
        array, role, text = self.each
        items = F.variant_get(record, array, f"array<struct<`{role}`:string,`{text}`:string>>")
        return F.transform(items, lambda x: _turn(self._role(x[role]), x[text]))

    def _role(self, role: Column) -> Column:
        renamed = role
        for old, new in self.roles:
            renamed = F.when(role == old, F.lit(new)).otherwise(renamed)
        return renamed


def _said_by(record: Column, role: str) -> Column:
    """A role is a name, or a JSON path to one."""
    return F.variant_get(record, role, "string") if role.startswith("$.") else F.lit(role)


def _turn(role: Column, text: Column) -> Column:
    none = F.lit("")
    return F.struct(F.coalesce(role, none).alias("role"), F.coalesce(text, none).alias("text"))


_SHARED_ROLES = (("human", "user"), ("gpt", ASSISTANT), ("bot", ASSISTANT))
LAYOUTS = (
    Layout("turn", "OBJECT<role, text>", (("$.role", "$.text"),)),
    Layout("prompt", "OBJECT<prompt>", (("user", "$.prompt"),)),
    Layout("completion", "OBJECT<completion>", ((ASSISTANT, "$.completion"),)),
    Layout("prompt_completion", "OBJECT<completion, prompt>", (("user", "$.prompt"), (ASSISTANT, "$.completion"))),
    Layout("prompt_response", "OBJECT<prompt, response>", (("user", "$.prompt"), (ASSISTANT, "$.response"))),
    Layout("question_answer", "OBJECT<answer, question>", (("user", "$.question"), (ASSISTANT, "$.answer"))),
    Layout("instruction", "OBJECT<instruction, output>", (("user", "$.instruction"), (ASSISTANT, "$.output"))),
    Layout(
        "instruction_input", "OBJECT<input, instruction, output>",
        (("system", "$.instruction"), ("user", "$.input"), (ASSISTANT, "$.output")),
    ),
    Layout("messages", "OBJECT<messages: ARRAY<OBJECT<content, role>>>", each=("$.messages", "role", "content")),
    Layout(
        "conversations", "OBJECT<conversations: ARRAY<OBJECT<from, value>>>",
        each=("$.conversations", "from", "value"), roles=_SHARED_ROLES,
    ),
)


def shape(record: Column) -> Column:
    """The nested field paths of a variant, without the types of values."""
    return F.regexp_replace(
        F.schema_of_variant(record), r": (?!OBJECT|ARRAY)[A-Z_]+(?:\([0-9, ]+\))?", ""
    )


#: Spark's JSON reader takes strings up to so many characters.
LONGEST = 20_000_000


def _read(value: Column, record: Column, kind: str, otherwise: Column) -> Column:
    """``otherwise`` where ``value`` is null; a record too long to be read raises instead."""
    failure = F.raise_error(F.lit(f"a record of more than {LONGEST} characters cannot be read")).cast(kind)
    return F.when(value.isNull() & (F.length(record) > LONGEST), failure).when(value.isNull(), otherwise)


def _layout(value: Column, record: Column, fingerprint: Column) -> Column:
    layout = _read(value, record, "string", F.lit("unreadable"))
    for known in LAYOUTS:
        layout = layout.when(fingerprint == known.fingerprint, known.name)
    return layout.otherwise("unknown")


def canonical_turns(records: DataFrame, record: str = "record") -> DataFrame:
    """``records`` with ``layout`` and ``turns``, an array of (role, text), instead of ``record``.

    Null or broken JSON has layout "unreadable", an unknown shape "unknown"; both
    have no turns and stay in the result, and :func:`unread_records` has their text.  Null
    roles and texts are empty.  A record of more than ``LONGEST`` characters that the JSON
    reader does not take raises, so that no text is lost unseen.
    """
    parsed = records.withColumn("__record", F.try_parse_json(record))
    parsed = parsed.withColumn("__fingerprint", F.sha2(shape(F.col("__record")), 256))
    value, kind = F.col("__record"), "array<struct<role:string,text:string>>"
    turns = _read(value, F.col(record), kind, F.array().cast(kind))
    for known in LAYOUTS:
        turns = turns.when(F.col("__fingerprint") == known.fingerprint, known.canonical(value))
    return parsed.select(
        *(F.col(c) for c in records.columns if c not in (record, "layout", "turns")),
        _layout(value, F.col(record), F.col("__fingerprint")).alias("layout"),
        turns.otherwise(F.array().cast(kind)).alias("turns"),
    )


def unread_records(records: DataFrame, record: str = "record") -> DataFrame:
    """The rows of ``records`` that have no turns, with ``layout``: unreadable or unknown."""
    value = F.try_parse_json(record)
    named = records.withColumn("layout", _layout(value, F.col(record), F.sha2(shape(value), 256)))
    return named.where(F.col("layout").isin("unreadable", "unknown"))


def escape(text: Column) -> Column:
    """Control strings cannot occur in the result; see :func:`unescape`."""
    text = F.regexp_replace(text, "&(?=(?:amp;)*(?:lt|lsqb);)", "&amp;")
    text = F.regexp_replace(text, "<(?=/?s>)", "&lt;")
    return F.regexp_replace(text, r"\[(?=/?INST\])", "&lsqb;")


def unescape(text: Column) -> Column:
    text = F.regexp_replace(text, "&lt;(?=/?s>)", "<")
    text = F.regexp_replace(text, r"&lsqb;(?=/?INST\])", "[")
    return F.regexp_replace(text, "&amp;(?=(?:amp;)*(?:lt|lsqb);)", "&")


def format_chat(records: DataFrame, key: str = "conv_id", turn: str = "turn") -> DataFrame:
    """One row per conversation: ``key``, ``formatted`` and ``loss``, spans of assistant text.

    ``records`` has ``key``, ``turn`` and ``turns``.  Turns are ordered by ``turn``
    (null first), their place in the record, role and text, so repeated turns have
    one order.  Rows with a null key form one conversation; one without any turns has
    an empty text.  ``loss`` holds start
    and end in code points of ``formatted``.
    """
    turns = records.select(key, F.col(turn).alias("__turn"), F.posexplode_outer("turns").alias("__at", "__said"))
    turns = turns.select(
        key, "__turn", "__at",
        F.col("__said.role").alias("__role"), F.col("__said.text").alias("__text"),
        F.concat(F.lit("<s>"), escape(F.col("__said.role")), F.lit("[INST]")).alias("__head"),
        escape(F.col("__said.text")).alias("__body"),
    )
    turns = turns.withColumn("__piece", F.concat("__head", "__body", F.lit("[/INST]</s>")))
    order = Window.partitionBy(key).orderBy("__turn", "__at", "__role", "__text")
    size = F.length("__piece").cast("long")
    turns = turns.withColumn("__no", F.row_number().over(order)).withColumn(
        "__start", F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0)) - size + F.length("__head")
    )
    span = F.struct(F.col("__start").alias("start"), (F.col("__start") + F.length("__body")).alias("end"))
    pieces = F.sort_array(F.collect_list(F.struct("__no", "__piece")))
    return turns.groupBy(key).agg(
        F.array_join(F.transform(pieces, lambda p: p["__piece"]), "").alias("formatted"),
        F.sort_array(F.collect_list(F.when(F.col("__role") == ASSISTANT, span))).alias("loss"),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text, an array of (role, text)."""
    whole = F.filter(F.split(formatted, "</s>"), lambda p: p != "")
    return F.transform(
        whole,
        lambda p: F.struct(
            unescape(F.substring_index(F.substring(p, 4, 1 << 30), "[INST]", 1)).alias("role"),
            unescape(F.regexp_extract(p, r"(?s)^<s>.*?\[INST\](.*)\[/INST\]$", 1)).alias("text"),
        ),
    )


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest over ``conversations`` and conversation -1.

    Rows become records of three layouts by their role, conversation -1 one of a
    fourth, so fingerprints decide for every row.
    """
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    record = (
        F.when(role == "user", F.to_json(F.struct(text.alias("prompt"))))
        .when(role == ASSISTANT, F.to_json(F.struct(text.alias("completion"))))
        .otherwise(F.to_json(F.struct(role.alias("role"), text.alias("text"))))
    )
    said = "</s>[INST] ok [/INST]"
    added = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.lit(0).cast("long").alias("turn"),
        F.lit(
            '{"messages": [{"role": "user", "content": "%s"}, {"role": "assistant", "content": "%s"}]}' % (said, said)
        ).alias("record"),
    )
    records = rows.select("conv_id", F.col("turn").cast("long"), record.alias("record")).unionByName(added)
    chats = format_chat(canonical_turns(records))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join(
        F.transform(
            "loss",
            lambda s: unescape(
                F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
            ),
        ),
        "",
    )
    chats = chats.withColumn("turns", read_back(F.col("formatted"))).withColumn("learnt", learnt)
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
