"""Chat formatting: event logs folded into final messages, then rendered with a loss mask.

A conversation is logged as events. Each names its conversation, its place in the conversation's
sequence, message position (``turn``, and ``part`` for messages that share a turn), role and text, and
is one of

- ``delta``       text appended to the message,
- ``edit``        the message's text is replaced,
- ``regenerate``  the message is cleared; what follows builds it anew.

The fold groups by message, not by conversation, so one conversation with a third of all events is
spread over many tasks; only the final messages of a conversation meet, as its formatted text is one
value. Everything is DataFrame functions.

Template: ``<|role|>``, newline, text, ``<|end|>``, newline for each message. Inside roles and texts
``\\``, ``<`` and ``[`` (and ``>`` in roles) become a backslash and a letter, so a text holds no
``<`` or ``[`` and thus no control string (``<|end|>``, ``</s>``, ``[INST]``); every backslash starts
such a pair, so reading the pairs back gives the text exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table

END = "<|end|>\n"
LEARNED_ROLE = "assistant"
DELTA_CHARS = 512


#: Characters of control strings and the letters that stand for them; the backslash goes first.
ESCAPES = (("\\", "e"), ("<", "l"), ("[", "b"), (">", "g"))


def escaped(text: Column, also_end: bool = False) -> Column:
    for char, letter in ESCAPES if also_end else ESCAPES[:3]:
        text = F.replace(text, F.lit(char), F.lit("\\" + letter))
    return text


def unescaped(text: Column) -> Column:
    for char, letter in reversed(ESCAPES):
        text = F.replace(text, F.lit("\\" + letter), F.lit(char))
    return text


def folded(events: DataFrame) -> DataFrame:
    """Final messages: ``conv_id``, ``turn``, ``part``, ``role``, ``text``.

    ``events``: ``conv_id``, ``seq``, ``turn``, ``part``, ``kind``, ``role``, ``text``. A message is
    what its events since the last edit or regenerate add up to, in order of ``seq`` (of any type with an order); events with
    equal ``seq`` apply in order of kind and text, and one logged twice counts once. Its role is that of its last event with one. Null
    texts are empty; a message whose last event is a bare regenerate is empty, not gone.
    """
    steps = F.sort_array(F.collect_set(F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"), "role")))
    resets = F.filter(F.col("steps"), lambda e: e["kind"].isin("edit", "regenerate"))
    last = F.array_position(F.col("steps"), F.element_at(resets, -1))
    live = F.when(F.size(resets) > 0, F.slice("steps", last, F.size("steps"))).otherwise(F.col("steps"))
    texts = F.transform(F.filter(live, lambda e: e["kind"] != "regenerate"), lambda e: e["text"])
    roles = F.filter(F.transform("steps", lambda e: e["role"]), lambda r: r.isNotNull())
    grouped = events.groupBy("conv_id", "turn", "part").agg(steps.alias("steps"))
    return grouped.select("conv_id", "turn", "part", F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"), F.array_join(texts, "").alias("text"))


def rendered(messages: DataFrame) -> DataFrame:
    """One formatted text a conversation: ``conv_id``, ``formatted``, ``loss_spans``.

    ``loss_spans`` are the code point ranges (``start``, ``length``) of the assistant texts.
    """
    head = F.concat(F.lit("<|"), escaped(F.col("role"), also_end=True), F.lit("|>\n"))
    body = escaped(F.col("text"))
    pieces = messages.select("conv_id", "turn", "part", "role", head.alias("head"), body.alias("body"))
    pieces = pieces.withColumns({"skip": F.length("head"), "size": F.length("body")})
    before = Window.partitionBy("conv_id").orderBy("turn", "part").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.col("skip") + F.col("size") + len(END)).over(before), F.lit(0))
    pieces = pieces.withColumn("start", offset + F.col("skip"))
    span = F.when(F.col("role") == LEARNED_ROLE, F.struct("start", F.col("size").cast("long").alias("length")))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "part", F.concat("head", "body", F.lit(END)).alias("piece"), span.alias("span"))))
    return pieces.groupBy("conv_id").agg(ordered.alias("ordered")).select(
        "conv_id",
        F.array_join(F.transform("ordered", lambda p: p["piece"]), "").alias("formatted"),
        F.filter(F.transform("ordered", lambda p: p["span"]), lambda s: s.isNotNull()).alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and masked text recovered from ``formatted`` and ``loss_spans`` alone.

    Adds ``turns`` (role, text), in order, and ``loss_text``. Spans are cut from the four-byte form
    of the text, where a code point has a fixed place, so long conversations stay linear.
    """
    pieces = F.split("formatted", r"<\|end\|>\n", -1)
    def turn(piece: Column) -> Column:
        at = F.instr(piece, "|>\n")
        return F.struct(unescaped(F.substring(piece, F.lit(3), at - 3)).alias("role"), unescaped(F.substring(piece, at + 3, F.length(piece))).alias("text"))
    turns = F.transform(F.filter(pieces, lambda p: p != ""), turn)
    def cut(wide: Column) -> Column:
        return F.array_join(F.transform("loss_spans", lambda s: unescaped(F.decode(
            F.substring(wide, (s["start"] * 4 + 1).cast("int"), (s["length"] * 4).cast("int")), "UTF-32"))), "")
    masked = F.transform(F.array(F.encode("formatted", "UTF-32")), cut)[0]
    return formatted.withColumn("turns", turns).withColumn("loss_text", masked)


def messages_of(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``part``, ``role``, ``text`` of a table of finished turns, nulls of role and text empty.

    Rows that share a conversation and turn are separate messages, in order of role and text; repeats
    stay. A null turn comes first.
    """
    text = F.coalesce("text", F.lit(""))
    role = F.coalesce("role", F.lit(""))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    return rows.withColumn("part", F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text")))


def deltas(text: Column, chars: int, first: Column) -> Column:
    """``text`` as (kind, text) events of at most ``chars`` characters, the first of kind ``first``; an empty text is one event."""
    count = F.greatest(F.ceil(F.length(text) / chars).cast("int"), F.lit(1))
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct(
        F.when(i == 0, first).otherwise(F.lit("delta")).alias("kind"), F.substring(text, i * chars + 1, F.lit(chars)).alias("text")))


def conversation_events(conversations: DataFrame, chars: int = DELTA_CHARS) -> DataFrame:
    """The event log of a table of finished turns: each text as the deltas it was streamed in."""
    rows = messages_of(conversations)
    return rows.select("conv_id", "turn", "part", "role", F.posexplode(deltas(F.col("text"), chars, F.lit("delta"))).alias("seq", "event")).select(
        "conv_id", "turn", "part", "role", F.col("seq").cast("long").alias("seq"), "event.kind", "event.text")


def revised_events(conversations: DataFrame, chars: int = DELTA_CHARS, regenerated: int = 3, edited: int = 5) -> DataFrame:
    """An event log with drafts whose fold gives back the turns of a finished table.

    One in ``regenerated`` assistant messages (by a hash of their place) was streamed as a draft first and
    regenerated, one in ``edited`` user messages was typed as a draft and edited; all others are plain
    deltas. Drafts are streamed in their turn, revisions after the whole session: ``seq``
    (round, turn, part, step) orders all events of a conversation, and a revised message's events lie apart in it.
    """
    place = F.xxhash64("conv_id", "turn", "part")
    again = (F.col("role") == LEARNED_ROLE) & (F.pmod(place, F.lit(regenerated)) == 0)
    retyped = (F.col("role") == "user") & (F.pmod(place, F.lit(edited)) == 0)
    plain, none = F.lit("delta"), F.array().cast("array<struct<kind:string,text:string>>")
    rows = messages_of(conversations).withColumns({"again": again, "retyped": retyped, "draft": F.concat(F.reverse("text"), F.lit(" <|end|>"))})
    cleared = F.array(F.struct(F.lit("regenerate").alias("kind"), F.lit(None).cast("string").alias("text")))
    revised = F.col("again") | F.col("retyped")
    rounds = F.array(
        F.when(revised, deltas(F.col("draft"), chars, plain)).otherwise(deltas(F.col("text"), chars, plain)),
        F.when(F.col("again"), F.concat(cleared, deltas(F.col("text"), chars, plain)))
        .when(F.col("retyped"), deltas(F.col("text"), chars, F.lit("edit"))).otherwise(none))
    events = rows.select("conv_id", "turn", "part", "role", F.posexplode(rounds).alias("round", "steps"))
    events = events.select("conv_id", "turn", "part", "role", "round", F.posexplode("steps").alias("step", "event"))
    return events.select("conv_id", "turn", "part", "role", F.struct("round", "turn", "part", "step").alias("seq"), "event.kind", "event.text")


def digests(formatted: DataFrame) -> DataFrame:
    """Checks of a formatted table, all computed from what :func:`read_back` recovers."""
    back = read_back(formatted)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op4_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and the control-string conversation -7, logged with drafts, edits and
    regenerations, folded, formatted and read back.

    Null conversation ids form one conversation. An empty table leaves conversation -7.
    """
    trap = "</s>[INST] ok [/INST]"
    table = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(*[value.cast(table.schema[name].dataType).alias(name) for name, value in {
        "conv_id": F.lit(-7), "turn": F.col("id"), "role": F.when(F.col("id") == 0, "user").otherwise(LEARNED_ROLE), "text": F.lit(trap)}.items()])
    return digests(rendered(folded(revised_events(table.unionByName(extra)))))
