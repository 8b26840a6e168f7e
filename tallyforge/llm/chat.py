"""Chat logs rebuilt from their events and rendered for training, with DataFrame operations only.

A log has events ``conv_id``, ``seq``, ``kind``, ``message``, ``role`` and ``text``. They are
partitioned by conversation, sorted by ``seq`` and folded:

* ``message`` starts the message at a position, or replaces it,
* ``delta`` appends to it, as text is streamed,
* ``edit`` replaces its text, and drops the later messages recorded so far,
* ``regenerate`` empties it and drops the later messages; the deltas that follow fill it again.

Events are first folded per message, so that a message streamed in many pieces is small before
messages of a conversation meet. A conversation ends up in one row, as its rendering is one
text; the size of a conversation is the only thing a task has to hold.

Rendered, a turn is ``<s>[INST] role [/INST]text</s>``. In roles and texts a backslash is doubled
and each control string gets a backslash after its first character, so none is left in them, and
reading back turns both into what they were. Spans of assistant texts, in code points of the
rendering, are the loss mask.

Results for special rows: a null text or role counts as empty, a null kind as ``message``. A null
``seq`` comes first. Events with one ``seq`` are ordered by kind, role and text. A delta for a
message never started starts it. Repeated events apply twice. Null ids form one conversation.
An empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

OPEN, MIDDLE, CLOSE = "<s>[INST] ", " [/INST]", "</s>"
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
TRAINED_ROLE = "assistant"
STARTS = ("message", "edit", "regenerate")
RESETS = ("edit", "regenerate")


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROL:
        text = F.replace(text, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def turn_events(turns: DataFrame) -> DataFrame:
    """Events for a table of finished turns ``conv_id``, ``turn``, ``role``, ``text``: one message
    each. Rows with one ``turn`` are ordered by role and text, and each stays a message."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    return rows.select(
        "conv_id",
        place.cast("bigint").alias("seq"),
        F.lit("message").alias("kind"),
        place.cast("bigint").alias("message"),
        "role",
        "text",
    )


def fold(events: DataFrame) -> DataFrame:
    """The final messages: ``conv_id``, ``message``, ``role``, ``text``."""
    kind = F.coalesce("kind", F.lit("message"))
    event = F.struct("seq", kind.alias("kind"), "role", F.coalesce("text", F.lit("")).alias("text"))
    messages = events.groupBy("conv_id", "message").agg(
        F.sort_array(F.collect_list(event)).alias("log"),
        F.max(F.when(kind.isin(*RESETS), F.col("seq"))).alias("reset"),
    )
    earlier = Window.partitionBy("conv_id").orderBy("message")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    messages = messages.withColumn("cut", F.max("reset").over(earlier))
    messages = messages.withColumn(
        "live", F.filter("log", lambda e: F.col("cut").isNull() | (e.seq > F.col("cut")))
    ).filter(F.size("live") > 0)
    place = F.transform("live", lambda e, i: F.when(e.kind.isin(*STARTS), i))
    begin = F.coalesce(F.array_max(place), F.lit(0))
    last = F.slice("live", begin + 1, F.size("live"))
    roles = F.filter(F.transform("live", lambda e: e.role), lambda r: r.isNotNull())
    return messages.select(
        "conv_id",
        "message",
        F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"),
        F.array_join(F.transform(last, lambda e: e.text), "").alias("text"),
    )


def render(messages: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """``conv_id``, ``formatted`` and ``loss_spans``, the texts to learn from as (start, end)."""
    parts = messages.select(
        "conv_id",
        "message",
        (F.col("role") == trained_role).alias("learned"),
        F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MIDDLE)).alias("head"),
        escape(F.col("text")).alias("body"),
    )
    turns = parts.withColumn("turn", F.concat("head", "body", F.lit(CLOSE)))
    before = Window.partitionBy("conv_id").orderBy("message", "turn")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.length("turn")).over(before), F.lit(0))
    placed = turns.withColumn("start", offset + F.length("head"))
    span = F.struct("start", (F.col("start") + F.length("body")).alias("end"))
    return placed.groupBy("conv_id").agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("message", "turn"))), lambda t: t.turn), ""
        ).alias("formatted"),
        F.sort_array(F.collect_list(F.when(F.col("learned"), span))).alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id``, ``turns`` (role, text) and ``learned``, the unescaped texts under the mask,
    all taken from ``formatted`` and ``loss_spans``."""
    # Neither control string is left inside a role or a text, so splitting is exact.
    pieces = F.split("formatted", CLOSE)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        head, text = (F.get(F.split(piece, r" \[/INST\]", 2), i) for i in (0, 1))
        role = F.substring(head, F.lit(len(OPEN) + 1), F.length(head))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    # Four bytes for each code point, so a span is cut out without walking the text. The last
    # character of the head comes along: alone, a leading byte order mark would be swallowed.
    def learned(span: Column) -> Column:
        count = (span.end - span.start + 1).cast("int")
        cut = F.substring(F.col("points"), (span.start.cast("int") - 1) * 4 + 1, count * 4)
        return unescape(F.substring(F.decode(cut, "UTF-32"), F.lit(2), count))

    rows = formatted.withColumn("points", F.encode("formatted", "UTF-32"))
    return rows.select(
        "conv_id",
        F.transform(pieces, turn).alias("turns"),
        F.transform("loss_spans", learned).alias("learned"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def digests(read: DataFrame) -> DataFrame:
    """Counts and digests of what was read back, one row per conversation."""
    turns = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    learned = F.array_join("learned", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        "formatted_chars",
    )
