"""Chat formatting from typed content parts, reversible, with loss mask and attachments.

A message has a role and an ordered list of parts; a part is a struct ``kind, text, ref,
tokens`` whose kind is text, image, audio or document. The visitor flattens the parts in
order: neighbouring texts are joined and escaped, every other part becomes the placeholder
of its kind, and its reference and the number of tokens it expands to are recorded.

A turn is ``<s>role\\ntext</s>`` where the assistant speaks and ``[INST]role\\ntext[/INST]``
elsewhere. Control strings inside texts get a backslash after their first character, one
more than they had, so that unescaping by one less restores every text. Line breaks in
roles are escaped too. Everything is made of column expressions.

The loss mask is a list of spans (first code point from 0, length): the assistants' texts.

Defined cases: null text, role or parts read as empty; a part of another or no kind is
text, and texts that follow each other read back as one; turns of one conversation are ordered by turn, then role and text, null turns first;
repeated rows are turns of their own; rows without ``conv_id`` form one conversation; an
empty table gives no rows; further columns are ignored. A conversation is one output row,
so it must fit in a task like a document; rows are flattened before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ASSISTANT = "assistant"
OPEN, CLOSE = "[INST]", "[/INST]"
OPEN_LOSS, CLOSE_LOSS = "<s>", "</s>"
PLACEHOLDERS = {"image": "<image>", "audio": "<audio>", "document": "<document>"}
# Tokens that a part expands to if it does not say so itself.
TOKENS = {"image": 256, "audio": 128, "document": 512}

_CONTROL = r"/?s>|/?INST\]|image>|audio>|document>"
_PLAIN = rf"([<\[])(\\*)({_CONTROL})"
_ESCAPED = rf"([<\[])\\(\\*)({_CONTROL})"
PART = "struct<kind: string, text: string, ref: string, tokens: bigint>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _escape_role(role: Column) -> Column:
    marked = F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\l"))
    return escape(marked)


def _unescape_role(role: Column) -> Column:
    marked = unescape(role)
    return F.replace(F.replace(marked, F.lit("\\l"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def text_parts(text: Column) -> Column:
    """A plain text as the list of its one part."""
    nothing = F.lit(None)
    part = F.struct(
        F.lit("text").alias("kind"),
        text.alias("text"),
        nothing.cast("string").alias("ref"),
        nothing.cast("bigint").alias("tokens"),
    )
    return F.array(part.cast(PART))


def _visited(parts: Column) -> Column:
    """The text that stands for the parts, in order.

    Neighbouring texts are joined before they are escaped, as two harmless ends may make a
    control string together. A placeholder between them cannot be part of one.
    """
    nothing = F.lit("")

    def step(seen: Column, part: Column) -> Column:
        attached = part["kind"].isin(*PLACEHOLDERS)
        placeholder = nothing
        for kind, told in PLACEHOLDERS.items():
            placeholder = F.when(part["kind"] == kind, F.lit(told)).otherwise(placeholder)
        closed = F.concat(seen["done"], escape(seen["open"]), placeholder)
        text = F.concat(seen["open"], F.coalesce(part["text"], nothing))
        return F.struct(
            F.when(attached, closed).otherwise(seen["done"]).alias("done"),
            F.when(attached, nothing).otherwise(text).alias("open"),
        )

    start = F.struct(nothing.alias("done"), nothing.alias("open"))
    return F.aggregate(parts, start, step, lambda s: F.concat(s["done"], escape(s["open"])))


def _expanded(part: Column) -> Column:
    tokens = F.lit(0)
    for kind, default in TOKENS.items():
        tokens = F.when(part["kind"] == kind, F.lit(default)).otherwise(tokens)
    return F.coalesce(part["tokens"], tokens).cast("bigint")


def _attachments(parts: Column, turn: Column) -> Column:
    attached = F.filter(parts, lambda p: p["kind"].isin(*PLACEHOLDERS))
    return F.transform(
        attached,
        lambda p, i: F.struct(
            turn.alias("turn"),
            i.alias("place"),
            p["kind"].alias("kind"),
            p["ref"].alias("ref"),
            _expanded(p).alias("tokens"),
        ),
    )


def formatted(messages: DataFrame) -> DataFrame:
    """Conversations of ``conv_id, turn, role, parts``, a row each.

    ``formatted`` is the text, ``loss`` the spans under the loss mask, ``attachments`` the
    references in the order of their placeholders, ``attached_tokens`` their sum.
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    body = _visited(F.col("parts"))
    rows = messages.select(
        "conv_id",
        "turn",
        role.alias("role"),
        F.coalesce(body, F.lit("")).alias("body"),
        F.coalesce("parts", F.array().cast(f"array<{PART}>")).alias("parts"),
    )
    speaks = F.col("role") == ASSISTANT
    head = F.concat(
        F.when(speaks, OPEN_LOSS).otherwise(OPEN), _escape_role(F.col("role")), F.lit("\n")
    )
    tail = F.when(speaks, CLOSE_LOSS).otherwise(CLOSE)
    rows = rows.select(
        "conv_id",
        "turn",
        "role",
        speaks.alias("speaks"),
        F.length(head).alias("head_chars"),
        F.length("body").alias("body_chars"),
        F.concat(head, "body", tail).alias("text"),
        "parts",
    )
    order = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_first(), "role", "text"
    )
    before = F.coalesce(
        F.sum(F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    rows = rows.withColumn("place", F.row_number().over(order)).withColumn(
        "span",
        F.when(
            F.col("speaks"),
            F.struct(
                (before + F.col("head_chars")).alias("first"),
                F.col("body_chars").cast("bigint").alias("length"),
            ),
        ),
    )
    turns = rows.groupBy("conv_id").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "place",
                    "text",
                    "span",
                    _attachments(F.col("parts"), F.col("place")).alias("attached"),
                )
            )
        ).alias("turns")
    )
    attachments = F.flatten(F.col("turns.attached"))
    return turns.select(
        "conv_id",
        F.array_join("turns.text", "").alias("formatted"),
        F.filter(F.col("turns.span"), lambda s: s.isNotNull()).alias("loss"),
        attachments.alias("attachments"),
        F.aggregate(
            attachments, F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]
        ).alias("attached_tokens"),
    )


def read_turns(text: Column) -> Column:
    """The turns of a formatted text: array of ``role, text``; placeholders stay in texts."""
    closed = F.split(text, r"</s>|\[/INST\]", -1)
    turns = F.slice(closed, F.lit(1), F.size(closed) - 1)
    return F.transform(turns, _read_turn)


def _read_turn(turn: Column) -> Column:
    opened = F.when(turn.startswith(OPEN_LOSS), len(OPEN_LOSS)).otherwise(len(OPEN))
    inner = F.substring(turn, opened + 1, F.length(turn))
    role = F.substring_index(inner, "\n", 1)
    text = F.substring(inner, F.length(role) + 2, F.length(inner))
    return F.struct(_unescape_role(role).alias("role"), unescape(text).alias("text"))


def read_loss(text: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between the spans."""
    return F.array_join(
        F.transform(
            loss,
            lambda s: unescape(
                F.substring(text, (s["first"] + 1).cast("int"), s["length"].cast("int"))
            ),
        ),
        "",
    )
