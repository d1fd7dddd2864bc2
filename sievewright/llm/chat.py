"""Chat formatting that reads back exactly (operator 2), in DataFrame functions alone.

A conversation's turns, in order of turn, role and text, are rendered by a template, the
result is parsed again by a deterministic parser and compared with the source. Rendering
starts without escapes; where the parsed turns differ, or a control string stands inside
a turn, the conversation is rendered again with its control strings escaped, and at last
with its texts in base64, for templates whose marks run into the ends of texts. Escaping
puts a backslash before the second character of a control string and doubles backslashes,
so it can always be undone.

Null roles and texts are empty. Rows with a null conversation id form one conversation.
Repeated rows are repeated turns. Empty tables give no conversation. Extra columns are
ignored. A conversation is one cell of the result, so its rows meet in one task.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

LEVELS = 3
WHOLE = "\\b"  # begins a text that is coded as a whole


@dataclass(frozen=True)
class ChatTemplate:
    """``open`` role ``middle`` text ``close`` for each turn; ``controls`` may never stand
    inside a role or a text as they are."""

    open: str = "<s>"
    middle: str = "[INST]"
    close: str = "[/INST]</s>"
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]")
    learned_role: str = "assistant"

    def escape(self, x: Column, level: int) -> Column:
        if level == 0:
            return x
        if level > 1:
            return F.concat(F.lit(WHOLE), F.base64(F.encode(x, "UTF-8")))
        x = F.replace(x, F.lit("\\"), F.lit("\\\\"))
        for c in self.controls:
            x = F.replace(x, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
        return x

    def unescape(self, x: Column) -> Column:
        whole = F.decode(F.try_to_binary(F.substring(x, F.lit(len(WHOLE) + 1), F.length(x)), F.lit("base64")), "UTF-8")
        return F.when(F.startswith(x, F.lit(WHOLE)), whole).otherwise(F.regexp_replace(x, r"(?s)\\(.)", "$1"))

    def render(self, turns: Column, level: int) -> Column:
        def one(t: Column) -> Column:
            return F.concat(
                F.lit(self.open), self.escape(t["role"], level),
                F.lit(self.middle), self.escape(t["text"], level), F.lit(self.close),
            )

        return F.array_join(F.transform(turns, one), "")

    def segments(self, formatted: Column) -> Column:
        """The rendered turns without their closing marks."""
        parts = F.split(formatted, re.escape(self.close))
        return F.slice(parts, F.lit(1), F.size(parts) - 1)

    def parse(self, formatted: Column) -> Column:
        """The turns, with null for a segment that breaks the grammar."""
        inside = "|".join(re.escape(c) for c in self.controls)

        def one(segment: Column) -> Column:
            halves = F.split(F.substring(segment, F.lit(len(self.open) + 1), F.length(segment)), re.escape(self.middle), 2)
            good = (
                F.startswith(segment, F.lit(self.open)) & (F.size(halves) == 2)
                & ~F.get(halves, F.lit(0)).rlike(inside) & ~F.get(halves, F.lit(1)).rlike(inside)
            )
            turn = F.struct(
                self.unescape(F.get(halves, F.lit(0))).alias("role"), self.unescape(F.get(halves, F.lit(1))).alias("text")
            )
            return F.when(good, turn)

        return F.transform(self.segments(formatted), one)


def format_chats(
    rows: DataFrame, template: ChatTemplate = ChatTemplate(), conv: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text",
) -> DataFrame:
    """One row per conversation: ``formatted``; the ``level`` of escaping it needed;
    ``recovered`` turns; and ``loss_runs``, for each turn the numbers of code points before,
    under and after the loss mask, which covers the texts of the learned role."""
    turns = rows.select(
        F.col(f"`{conv}`").alias("conv"),
        F.struct(
            F.col(f"`{turn}`").alias("turn"),
            F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
        ).alias("row"),
    )
    out = turns.groupBy("conv").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    out = out.select("conv", F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))).alias("source"))
    best, level = None, None
    for n in reversed(range(LEVELS)):
        out = out.withColumn(f"formatted{n}", template.render(F.col("source"), n))
        same = template.parse(F.col(f"formatted{n}")) == F.col("source")
        this = F.col(f"formatted{n}")
        best = this if best is None else F.when(same, this).otherwise(best)
        level = F.lit(n) if level is None else F.when(same, F.lit(n)).otherwise(level)
    out = out.select("conv", best.alias("formatted"), level.alias("level"))
    out = out.withColumn("recovered", template.parse(F.col("formatted")))
    out = out.withColumn("segments", template.segments(F.col("formatted")))

    def runs(segment: Column, t: Column) -> Column:
        before = F.locate(template.middle, segment) + F.lit(len(template.middle) - 1)
        whole = F.length(segment) + F.lit(len(template.close))
        learned = t["role"] == F.lit(template.learned_role)
        return F.when(
            learned, F.array(before, F.length(segment) - before, F.lit(len(template.close)))
        ).otherwise(F.array(whole, F.lit(0), F.lit(0)))

    return out.select(
        F.col("conv").alias(conv), "formatted", "level", "recovered",
        F.zip_with("segments", "recovered", runs).alias("loss_runs"),
    )


def masked_texts(formatted: Column, loss_runs: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    cut = F.zip_with(
        template.segments(formatted), loss_runs,
        lambda s, r: F.when(F.get(r, F.lit(1)) > 0, F.substring(s, F.get(r, F.lit(0)) + 1, F.get(r, F.lit(1)))),
    )
    return F.transform(F.filter(cut, lambda x: x.isNotNull()), template.unescape)


def chat_digest(formatted: DataFrame, template: ChatTemplate = ChatTemplate(), conv: str = "conv_id") -> DataFrame:
    """Counts and sha256 digests, read back from the formatted text and its mask."""
    turns = F.transform(template.parse(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(masked_texts(F.col("formatted"), F.col("loss_runs"), template), "")
    read = formatted.select(F.col(conv), "formatted", turns.alias("turns"), loss.alias("loss"))
    return read.select(
        F.col(conv),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
