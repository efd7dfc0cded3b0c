"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of one role
are merged into one message by array aggregation, over the places where the role changes, and
messages are concatenated:

    <|im_start|>role\\ntext<|turn|>text<|im_end|>\\n

``<|turn|>`` parts the turns of a merged message. No text can imitate a mark: a backslash
in a text becomes two, and ``<|`` becomes ``<\\|``, which reading undoes. In roles ``%``, line
feeds and ``<`` are percent-encoded. The loss mask lists where the assistant's texts stand,
in code points of the formatted string, each turn's text on its own.

Arrays are never grown one entry at a time over a whole conversation, and strings are not cut from
their start for every span: both happen in blocks of about the square root of the number of turns, so a
conversation of many thousand turns costs little more than as many short ones.

Null texts and roles count as empty. Turns with equal numbers are ordered by role and text;
a null turn comes first. Rows with a null conv_id form one conversation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the template.
START, END, TURN = "<|im_start|>", "<|im_end|>", "<|turn|>"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    # Every backslash of an escaped text starts a pair that stands for its second character.
    return F.regexp_replace(text, r"\\(.)", "$1")


_ROLE = (("%", "%25"), ("\n", "%0A"), ("<", "%3C"))


def escape_role(role: Column) -> Column:
    for plain, code in _ROLE:
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def unescape_role(role: Column) -> Column:
    for plain, code in reversed(_ROLE):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often and deep within loops it is used."""
    return F.transform(F.array(value), use)[0]


_MESSAGES = "array<struct<role:string,texts:array<string>>>"


def _merged(turns: Column) -> Column:
    """Messages ``(role, texts)``: runs of turns with one role, cut out where the role changes."""
    places = F.filter(
        F.sequence(F.lit(1), F.size(turns)),
        lambda i: (i == 1) | (F.element_at(turns, i)["role"] != F.element_at(turns, F.greatest(i - 1, F.lit(1)))["role"]),
    )

    def messages(held: Column) -> Column:
        def message(at: Column, k: Column) -> Column:
            after = F.coalesce(F.get(held, k + 1), F.size(turns) + 1)
            run = F.slice(turns, at, after - at)
            return F.struct(F.element_at(turns, at)["role"].alias("role"), F.transform(run, lambda t: t["text"]).alias("texts"))

        return F.transform(held, message)

    return _bound(places, messages).cast(_MESSAGES)


def _block(entries: Column) -> Column:
    """Entries in a block, about the square root of how many there are."""
    return F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(entries)))).cast("int")


def _blocks(entries: Column) -> Column:
    """The entries in blocks, an array of arrays."""
    starts = F.when(F.size(entries) > 0, F.sequence(F.lit(1), F.size(entries), _block(entries)))
    cut = F.transform(starts, lambda i: F.slice(entries, i, _block(entries)))
    return F.coalesce(cut, F.filter(F.array(entries), lambda _: F.lit(False)))


def _sums(numbers: Column) -> Column:
    """The sums of the first 0, 1, ... numbers."""
    return F.aggregate(
        numbers,
        F.array(F.lit(0).cast("long")),
        lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x)),
    )


def format_conversations(turns: DataFrame, assistant: str = ASSISTANT) -> DataFrame:
    """``(conv_id, formatted, loss_mask)`` from rows ``(conv_id, turn, role, text)``.

    ``loss_mask`` is an array of ``(start, length)``, code points of ``formatted`` from 0.
    """
    rows = turns.select(
        "conv_id",
        F.struct(
            "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
        ).alias("t"),
    )
    sorted_turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    messages = sorted_turns.select("conv_id", _merged(F.col("turns")).alias("messages"))
    # One piece per stretch of the string, and whether the loss counts it.
    piece = "array<struct<text:string,loss:boolean>>"

    def pieces(message: Column) -> Column:
        loss = message["role"] == assistant
        opening = F.concat(F.lit(START), escape_role(message["role"]), F.lit("\n"))
        bodies = F.transform(
            message["texts"],
            lambda text, i: F.array(
                F.struct(F.when(i > 0, F.lit(TURN)).otherwise(opening).alias("text"), F.lit(False).alias("loss")),
                F.struct(escape(text).alias("text"), loss.alias("loss")),
            ),
        )
        closing = F.array(F.struct(F.lit(END + "\n").alias("text"), F.lit(False).alias("loss")))
        return F.concat(F.flatten(bodies), closing).cast(piece)

    cut = messages.select("conv_id", F.flatten(F.transform("messages", pieces)).alias("pieces"))
    return cut.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"),
        _bound(_blocks(F.col("pieces")), _loss_spans).alias("loss_mask"),
    )


def _loss_spans(blocks: Column) -> Column:
    """Start and length of the pieces that the loss counts, by sums within each block and of those before."""

    def placed(inner: Column) -> Column:
        def spans(outer: Column) -> Column:
            def block(pieces: Column, k: Column) -> Column:
                def span(p: Column, i: Column) -> Column:
                    start = F.get(outer, k) + F.get(F.get(inner, k), i)
                    return F.when(p["loss"], F.struct(start.alias("start"), F.length(p["text"]).cast("long").alias("length")))

                return F.array_compact(F.transform(pieces, span))

            return F.flatten(F.transform(blocks, block))

        return _bound(_sums(F.transform(inner, lambda s: F.element_at(s, -1))), spans)

    sums = F.transform(blocks, lambda b: _sums(F.transform(b, lambda p: F.length(p["text"]).cast("long"))))
    return _bound(sums, placed)


def read_turns(formatted: Column) -> Column:
    """The turns ``(role, text)`` of a formatted string, as they were before merging."""

    def turns(message: Column) -> Column:
        role = unescape_role(F.substring_index(F.substr(message, F.lit(len(START) + 1)), "\n", 1))
        body = F.substr(message, F.locate("\n", message) + 1)
        return _bound(
            role,
            lambda r: F.transform(F.split(body, r"<\|turn\|>"), lambda t: F.struct(r.alias("role"), unescape(t).alias("text"))),
        )

    def messages(closed: Column) -> Column:
        return F.flatten(F.transform(F.slice(closed, 1, F.size(closed) - 1), turns))

    return _bound(F.split(formatted, r"<\|im_end\|>\n"), messages)


def loss_text(formatted: Column, mask: Column) -> Column:
    """All text under the mask, unescaped."""
    return _bound(F.struct(formatted.alias("text"), _blocks(mask).alias("blocks")), lambda h: _masked(h["text"], h["blocks"]))


def _masked(formatted: Column, blocks: Column) -> Column:
    def block(spans: Column) -> Column:
        first, last = spans[0], F.element_at(spans, -1)
        stretch = F.substr(formatted, (first["start"] + 1).cast("int"), (last["start"] + last["length"] - first["start"]).cast("int"))

        def parts(held: Column) -> Column:
            return F.transform(
                spans,
                lambda s: unescape(F.substr(held, (s["start"] - first["start"] + 1).cast("int"), s["length"].cast("int"))),
            )

        return F.array_join(_bound(stretch, parts), "")

    return F.array_join(F.transform(blocks, block), "")
