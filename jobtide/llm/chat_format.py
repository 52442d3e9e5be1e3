r"""Chat formatting with typed content parts, by DataFrame functions only.

Method: a visitor turns each part of a turn into a piece of text: text parts are escaped, image,
audio and document parts become placeholders numbered in order over the conversation, with their
reference and the tokens they expand to recorded beside.  A turn becomes

    <turn ROLE>\nBODY</turn>\n

and a conversation the turns in order.  The loss mask holds the code point ranges of the bodies of
the trained role.  Control strings inside texts get a backslash after their ``<`` (one more, if they
have some), so no text can close or open a turn, and the text is read back by taking it away again.
In roles, ``% < >`` and line feeds are written as ``%25 %3C %3E %0A``.  ``<part/>`` separates two
neighbouring text parts.

Nulls: a null text or part list is empty, a null role is the empty role, and rows without a conv_id
form one conversation.  Ties: turns of one number follow each other by role and content, so repeated
rows are repeated turns.  An empty table gives no conversation.  A conversation is one row of the
result, so it must fit in a task; nothing else is gathered.  Only conv_id, turn, role and text or
parts are read, so other columns cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PARTS = (
    "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
)
CONTROL = r"(/?turn|image|audio|document|part)"
ROLE_CODES = (("%", "%25"), ("<", "%3C"), (">", "%3E"), ("\n", "%0A"))
END = "</turn>\n"


@dataclass(frozen=True)
class Expansion:
    """Tokens an attachment expands to; ``default`` where its measures are missing."""

    patch: int = 14
    audio_per_second: int = 25
    document_per_page: int = 512
    default: int = 256

    def tokens(self, part: Column) -> Column:
        image = F.ceil(part["width"] / self.patch) * F.ceil(part["height"] / self.patch)
        measured = (
            F.when(part["type"] == "text", F.regexp_count(F.coalesce(part["text"], F.lit("")), F.lit(r"\w+|[^\w\s]")))
            .when(part["type"] == "image", image)
            .when(part["type"] == "audio", F.ceil(part["seconds"] * self.audio_per_second))
            .when(part["type"] == "document", part["pages"] * self.document_per_page)
        )
        return F.coalesce(measured, F.lit(self.default)).cast("long")


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)" + CONTROL, r"<\\$1$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)" + CONTROL, r"<$1$2")


def _role_written(role: Column) -> Column:
    for plain, code in ROLE_CODES:
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def _role_read(role: Column) -> Column:
    for plain, code in reversed(ROLE_CODES):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def text_part(text: Column) -> Column:
    """A part list that holds one text."""
    part = F.struct(
        F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"),
    )
    return F.array(part).cast(PARTS)


def visited(parts: Column, before: Column, expansion: Expansion) -> Column:
    """For each part: type, its piece of the body, reference, number and tokens.

    ``before`` counts the attachments of earlier turns.  Parts of other types than image, audio and
    document count as text.
    """

    def visit(part: Column, i: Column) -> Column:
        attached = part["type"].isin("image", "audio", "document")
        earlier = F.size(F.filter(F.slice(parts, 1, i), lambda p: p["type"].isin("image", "audio", "document")))
        number = F.when(attached, before + earlier + 1)
        after_text = (i > 0) & ~F.coalesce(F.get(parts, i - 1)["type"].isin("image", "audio", "document"), F.lit(False))
        text = F.concat(F.when(after_text, F.lit("<part/>")).otherwise(F.lit("")), escaped(F.coalesce(part["text"], F.lit(""))))
        piece = F.when(attached, F.concat(F.lit("<"), part["type"], F.lit(" "), number.cast("string"), F.lit("/>"))).otherwise(text)
        return F.struct(
            part["type"].alias("type"), piece.alias("piece"), part["ref"].alias("ref"), number.alias("number"),
            expansion.tokens(part).alias("tokens"),
        )

    return F.transform(parts, visit)


def format_chat(turns: DataFrame, trained_role: str = "assistant", expansion: Expansion = Expansion()) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, loss (ranges), attachments, n_tokens.

    ``turns`` has conv_id, turn, role and either ``parts`` (see ``PARTS``) or ``text``.
    """
    parts = F.col("parts").cast(PARTS) if "parts" in turns.columns else text_part(F.col("text"))
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce(parts, F.array().cast(PARTS)).alias("parts"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "parts")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    attached = F.size(F.filter("parts", lambda p: p["type"].isin("image", "audio", "document")))
    rows = rows.withColumns({
        "_position": F.row_number().over(order),
        "_before": F.coalesce(F.sum(attached).over(earlier), F.lit(0)),
    })
    rows = rows.withColumn("_parts", visited(F.col("parts"), F.col("_before"), expansion)).drop("parts")
    rows = rows.withColumns({
        "_head": F.concat(F.lit("<turn "), _role_written(F.col("role")), F.lit(">\n")),
        "_body": F.array_join(F.transform("_parts", lambda p: p["piece"]), ""),
    })
    size = F.char_length("_head") + F.char_length("_body") + len(END)
    by_place = Window.partitionBy("conv_id").orderBy("_position").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_from", F.coalesce(F.sum(size).over(by_place), F.lit(0)) + F.char_length("_head"))
    turn = F.struct(
        F.col("_position").alias("position"), F.concat("_head", "_body", F.lit(END)).alias("written"),
        (F.col("role") == trained_role).alias("trained"), F.col("_from").alias("start"),
        (F.col("_from") + F.char_length("_body")).alias("end"),
        F.filter("_parts", lambda p: p["number"].isNotNull()).alias("attached"),
        F.aggregate("_parts", F.lit(0).cast("long"), lambda s, p: s + p["tokens"]).alias("tokens"),
    )
    found = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("_turns"))
    return found.select(
        "conv_id", F.size("_turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("_turns", lambda t: t["written"]), "").alias("formatted"),
        F.transform(
            F.filter("_turns", lambda t: t["trained"]),
            lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end")),
        ).alias("loss"),
        F.flatten(F.transform("_turns", lambda t: F.transform(
            t["attached"], lambda a: F.struct(a["number"].alias("number"), a["type"].alias("type"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))
        ))).alias("attachments"),
        F.aggregate("_turns", F.lit(0).cast("long"), lambda s, t: s + t["tokens"]).alias("n_tokens"),
    )


def turns_of(formatted: Column) -> Column:
    """The turns of a formatted conversation: role and text, escapes taken away; placeholders stay."""
    written = F.split(formatted, END, -1)
    written = F.slice(written, 1, F.size(written) - 1)
    return F.transform(written, lambda t: F.struct(
        _role_read(F.regexp_extract(t, r"(?s)^<turn ([^>]*)>\n(.*)$", 1)).alias("role"),
        unescaped(F.replace(F.regexp_extract(t, r"(?s)^<turn ([^>]*)>\n(.*)$", 2), F.lit("<part/>"), F.lit(""))).alias("text"),
    ))


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, escapes taken away."""
    return F.array_join(
        F.transform(loss, lambda r: unescaped(F.replace(
            F.substr(formatted, (r["start"] + 1).cast("int"), (r["end"] - r["start"]).cast("int")), F.lit("<part/>"), F.lit("")
        ))), ""
    )
