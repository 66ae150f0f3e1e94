"""Conversations of typed content parts formatted for training.

A turn holds parts: text, image, audio or document. A visitor goes over them in order: text is escaped, any other part becomes a
placeholder, and is recorded with its reference and the number of tokens that the placeholder stands for. The template then marks
the turns, and the assistant's texts are the spans of the loss mask.

Control strings inside texts get a backslash after their first character, and backslashes are doubled, so that no text can
look like the template, and ``unescape`` gives it back. All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# The template: how a turn of a role opens and closes. Any other role is named inside its turn.
TURNS = {"user": ("[INST]", "[/INST]"), "assistant": ("[ASST]", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
OTHER, NAMED, OTHER_END = "[OTHER]", "[ROLE]", "[/OTHER]"
BEGIN = "<s>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
UNKNOWN = "<|attachment|>"
CONTROL = (BEGIN, *(m for pair in TURNS.values() for m in pair), OTHER, NAMED, OTHER_END, *PLACEHOLDERS.values(), UNKNOWN)
#: Tokens of a part: an image's by patches of this many pixels a side, an audio's by second, a document's by page.
PATCH, PER_SECOND, PER_PAGE = 14, 25, 256
PARTS = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"


def escape(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(f"{mark[0]}\\{mark[1:]}"))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"\\(\\?)"), F.lit("$1"))


def text_part(text: Column) -> Column:
    """The parts of a turn that is one text."""
    null = lambda kind: F.lit(None).cast(kind)
    return F.array(
        F.struct(
            F.lit("text").alias("type"), text.alias("text"), null("string").alias("ref"), null("int").alias("width"),
            null("int").alias("height"), null("double").alias("seconds"), null("int").alias("pages"),
        )
    )


def _tokens(part: Column) -> Column:
    patches = F.ceil(part["width"] / PATCH) * F.ceil(part["height"] / PATCH)
    by_type = (
        F.when(part["type"] == "image", patches)
        .when(part["type"] == "audio", F.ceil(part["seconds"] * PER_SECOND))
        .when(part["type"] == "document", part["pages"].cast("long") * PER_PAGE)
    )
    return F.coalesce(by_type, F.lit(0)).cast("long")


def visited(parts: Column) -> Column:
    """The parts flattened: escaped texts and placeholders, joined by nothing."""

    def visit(part: Column) -> Column:
        mark = F.lit(UNKNOWN)
        for kind, own in PLACEHOLDERS.items():
            mark = F.when(part["type"] == kind, F.lit(own)).otherwise(mark)
        return F.when(part["type"] == "text", escape(part["text"])).otherwise(mark)

    return F.concat_ws("", F.transform(F.coalesce(parts, F.array().cast(PARTS)), visit))


def attachments(parts: Column) -> Column:
    """The parts that are not text, in order: struct<type, ref, tokens>."""
    other = F.filter(F.coalesce(parts, F.array().cast(PARTS)), lambda p: ~p["type"].eqNullSafe(F.lit("text")))
    return F.transform(other, lambda p: F.struct(p["type"].alias("type"), p["ref"].alias("ref"), _tokens(p).alias("tokens")))


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, parts; other columns are not used).

    conv_id, formatted, loss_spans (array of struct<start, length>, in code points of ``formatted``), attachments (array of
    struct<turn, type, ref, tokens>, in the order of the placeholders), placeholder_tokens. Turns go by number, null first; equal
    numbers by role and text. Null texts are empty, null roles have an empty name; a null conv_id is a conversation; a
    table without rows gives none. A conversation's output is one value, so its size bounds a task: at most 2 GB of text.
    """
    role = F.coalesce("role", F.lit(""))
    opening, closing = F.concat(F.lit(f"{OTHER} "), escape(role), F.lit(f" {NAMED} ")), F.lit(f" {OTHER_END}")
    for name, (first, last) in TURNS.items():
        opening = F.when(role == name, F.lit(f"{first} ")).otherwise(opening)
        closing = F.when(role == name, F.lit(f" {last}")).otherwise(closing)
    rows = turns.select(
        "conv_id", "turn", role.alias("role"), visited(F.col("parts")).alias("body"), attachments(F.col("parts")).alias("attached")
    )
    rows = rows.select("conv_id", "turn", "role", "body", "attached", opening.alias("opening"), closing.alias("closing"))
    length = F.length("opening") + F.length("body") + F.length("closing")
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "body").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum(length).over(before), F.lit(0)) + len(BEGIN))
    rows = rows.select(
        "conv_id",
        F.struct(
            "at",
            "turn",
            F.concat("opening", "body", "closing").alias("piece"),
            "attached",
            F.when(F.col("role") == "assistant", F.struct((F.col("at") + F.length("opening")).alias("start"), F.length("body").cast("long").alias("length"))).alias("span"),
        ).alias("t"),
    )
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    recorded = F.flatten(
        F.transform("turns", lambda t: F.transform(t["attached"], lambda a: F.struct(t["turn"].alias("turn"), a["type"].alias("type"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))))
    )
    chats = chats.select(
        "conv_id",
        F.concat(F.lit(BEGIN), F.concat_ws("", F.transform("turns", lambda t: t["piece"]))).alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
        recorded.alias("attachments"),
    )
    return chats.withColumn("placeholder_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))


def _literal(text: str) -> str:
    return "".join(f"\\{c}" if not c.isalnum() and c not in "< >" else c for c in text)


_OPEN = "|".join(_literal(first) for first, _ in TURNS.values())
_CLOSE = "|".join(_literal(last) for _, last in TURNS.values())
_TURN = rf"(?s)({_OPEN}|{_literal(OTHER)} .*? {_literal(NAMED)}) (.*?) ({_CLOSE}|{_literal(OTHER_END)})"


def read_back(chats: DataFrame) -> DataFrame:
    """What ``formatted`` and ``loss_spans`` hold: conv_id, turns (array of struct<role, text>), loss_text, formatted."""

    def role(mark: Column) -> Column:
        out = unescape(F.expr("''"))
        out = unescape(F.regexp_replace(mark, F.lit(rf"(?s)^{_literal(OTHER)} (.*) {_literal(NAMED)}$"), F.lit("$1")))
        for name, (first, _) in TURNS.items():
            out = F.when(mark == first, F.lit(name)).otherwise(out)
        return out

    marks = F.regexp_extract_all("formatted", F.lit(_TURN), F.lit(1))
    bodies = F.regexp_extract_all("formatted", F.lit(_TURN), F.lit(2))
    turns = F.zip_with(marks, bodies, lambda m, b: F.struct(role(m).alias("role"), unescape(b).alias("text")))
    masked = F.transform("loss_spans", lambda s: unescape(F.substring("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return chats.select("conv_id", turns.alias("turns"), F.concat_ws("", masked).alias("loss_text"), "formatted")


def digest(read: DataFrame) -> DataFrame:
    """The contract's columns of ``read_back``'s rows."""
    lines = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
