"""Chat formatting: typed content parts become one string with ordered placeholders.

A turn holds an array of parts (text, image, audio, document). A visitor renders each part;
the parts that are not text leave a placeholder and an attachment record with the number of
model tokens that the placeholder stands for. Control strings within texts and roles are
escaped by one more backslash after their first character, which reading back removes.

Defined results: a NULL text, role or array of parts counts as empty; a part of unknown or
NULL type becomes a ``[FILE]`` placeholder of one token; NULL sizes count as 0 and give one
token at least; turns with the same number are ordered by role, then by their rendered text;
a turn without conversation id is a conversation of its own. Other columns are not carried.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """Marks of the format. ``reserved`` are further control strings to escape in texts."""

    begin: str = "<s>"
    turn: str = "[TURN]"
    says: str = "[SAYS]"
    between: str = "[PART]"
    end: str = "</s>"
    places: dict[str, str] = field(
        default_factory=lambda: {"image": "[IMAGE]", "audio": "[AUDIO]", "document": "[DOCUMENT]"}
    )
    unknown: str = "[FILE]"
    reserved: tuple[str, ...] = ("[INST]", "[/INST]", "[SYS]", "[/SYS]")

    def __post_init__(self):
        marks = self.controls()
        first = {mark[0] for mark in marks}
        if any(first & set(mark[1:]) for mark in marks) or any(ESCAPE in mark for mark in marks):
            raise ValueError("a control string may hold a first character only in front, and no backslash")

    def controls(self) -> list[str]:
        own = [self.begin, self.turn, self.says, self.between, self.end, self.unknown]
        return list(dict.fromkeys([*own, *self.places.values(), *self.reserved]))

    def _pattern(self, escapes: str) -> str:
        heads = "".join(re.escape(c) for c in sorted({m[0] for m in self.controls()}))
        tails = "|".join(re.escape(m[1:]) for m in self.controls())
        return rf"([{heads}]){escapes}({tails})"

    def escaped(self, text: Column) -> Column:
        return F.regexp_replace(text, self._pattern(r"(\\*)"), r"$1\\$2$3")

    def unescaped(self, text: Column) -> Column:
        return F.regexp_replace(text, self._pattern(r"\\(\\*)"), "$1$2$3")


@dataclass(frozen=True)
class PartVisitor:
    """Renders the parts of a turn. Override a method to change how a type is shown or
    how many tokens it stands for."""

    template: Template = Template()
    patch: int = 14
    audio_rate: float = 25.0
    page_tokens: int = 1024

    def text(self, part: Column) -> Column:
        return self.template.escaped(F.coalesce(part["text"], F.lit("")))

    def image_tokens(self, part: Column) -> Column:
        def patches(side: str) -> Column:
            return F.ceil(F.coalesce(part[side], F.lit(0)) / F.lit(self.patch))

        return patches("width") * patches("height")

    def audio_tokens(self, part: Column) -> Column:
        return F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * F.lit(self.audio_rate))

    def document_tokens(self, part: Column) -> Column:
        return F.coalesce(part["pages"], F.lit(0)).cast("long") * F.lit(self.page_tokens)

    def visit(self, part: Column) -> Column:
        """Rendered text, and the type and tokens of an attachment (NULL for text)."""
        places, kind = self.template.places, part["type"]
        is_text = kind.eqNullSafe("text")
        shown = F.when(is_text, self.text(part))
        tokens = F.when(is_text, F.lit(None).cast("long"))
        for name, mark in places.items():
            shown = shown.when(kind == name, F.lit(mark))
            count = getattr(self, f"{name}_tokens")(part).cast("long")
            tokens = tokens.when(kind == name, F.greatest(F.lit(1).cast("long"), count))
        known = kind.isin(*places)
        return F.struct(
            shown.otherwise(F.lit(self.template.unknown)).alias("shown"),
            F.when(is_text, F.lit(None)).when(known, kind).otherwise(F.lit("unknown")).alias("kind"),
            part["ref"].alias("ref"),
            tokens.otherwise(F.lit(1).cast("long")).alias("tokens"),
        )


def _attachments(body_start: Column, between: int) -> Column:
    """The parts that are not text, with the position of their placeholders."""

    def place(_: Column, i: Column) -> Column:
        before = F.aggregate(
            F.slice("visited", F.lit(1), i),
            F.lit(0).cast("long"),
            lambda total, p: total + F.length(p["shown"]) + F.lit(between),
        )
        p = F.element_at(F.col("visited"), i + 1)
        return F.struct(
            (body_start + before).alias("place"), p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens")
        )

    has = F.exists("visited", lambda p: p["kind"].isNotNull())
    none = F.lit(None).cast("array<struct<place:bigint,kind:string,ref:string,tokens:bigint>>")
    return F.when(has, F.filter(F.transform("visited", place), lambda a: a["kind"].isNotNull())).otherwise(none)


def format_conversations(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    parts: str = "parts",
    learned: tuple[str, ...] = ("assistant",),
    visitor: PartVisitor | None = None,
) -> DataFrame:
    """One row per conversation: ``formatted``; ``loss``, the spans (start, length) in code
    points that are learned; ``attachments`` in order; ``expanded_tokens``, the tokens that
    the placeholders stand for.

    The one shuffle is by conversation: positions come from a running sum over its turns.
    A conversation is one value of the result, so its turns have to meet in one task.
    """
    visitor = visitor or PartVisitor()
    t = visitor.template
    rendered = (
        turns.select(
            F.col(conversation).alias("conv_id"),
            F.when(F.col(conversation).isNull(), F.monotonically_increasing_id()).alias("alone"),
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.transform(F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>")), visitor.visit).alias("visited"),
        )
        .withColumn("body", F.array_join(F.transform("visited", lambda p: p["shown"]), t.between))
        .withColumn("head", F.concat(F.lit(t.turn), t.escaped(F.col("role")), F.lit(t.says)))
        .withColumn("piece", F.concat("head", "body", F.lit(t.end)))
    )
    order = Window.partitionBy("conv_id", "alone").orderBy("turn", "role", "body")
    before = F.sum(F.length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = rendered.withColumn("start", F.coalesce(before, F.lit(0)) + F.lit(len(t.begin))).withColumn(
        "body_start", F.col("start") + F.length("head")
    )
    span = F.struct(F.col("body_start").alias("start"), F.length("body").cast("long").alias("length"))
    gathered = placed.groupBy("conv_id", "alone").agg(
        F.sort_array(F.collect_list(F.struct("start", "piece"))).alias("pieces"),
        F.sort_array(F.collect_list(F.when(F.col("role").isin(*learned), span))).alias("loss"),
        F.flatten(F.collect_list(_attachments(F.col("body_start"), len(t.between)))).alias("attachments"),
    )
    whole = F.array_join(F.transform("pieces", lambda p: p["piece"]), "")
    return gathered.select(
        "conv_id",
        F.concat(F.lit(t.begin), whole).alias("formatted"),
        "loss",
        F.sort_array("attachments").alias("attachments"),
        F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]).alias("expanded_tokens"),
    )


def read_turns(formatted: Column, template: Template) -> Column:
    """The turns (role, text) of a formatted conversation whose parts are texts."""

    def one(piece: Column) -> Column:
        sides = F.split(piece, re.escape(template.says), 2)
        body = F.substring(sides[1], F.lit(1), F.length(sides[1]) - F.lit(len(template.end)))
        return F.struct(template.unescaped(sides[0]).alias("role"), template.unescaped(body).alias("text"))

    pieces = F.split(formatted, re.escape(template.turn), -1)
    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), one)


def read_loss(formatted: Column, loss: Column, template: Template) -> Column:
    """All text under the loss mask, unescaped."""
    learned = F.transform(
        loss, lambda s: template.unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
    )
    return F.array_join(learned, "")


def text_parts(text: Column) -> Column:
    """One text part, for tables whose turns hold plain text."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), *[
        F.lit(None).cast(kind).alias(name)
        for name, kind in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))
    ]))
