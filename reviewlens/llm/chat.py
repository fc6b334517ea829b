"""Chat formatting by event sourcing: logs of streamed, edited and regenerated messages become training text.

A log row is an event: `conv_id`, `turn`, `seq` (its place in the conversation's log), `op`, `role`, `text`.

op            effect on message `turn` of the conversation
message       begins a message with this role and text; a second one at the same turn is a further message
delta         appends its text to the message
edit          replaces the text of the message
regenerate    replaces the text and drops what later turns said before it

Everything is built from DataFrame functions, and one shuffle by conversation serves all of it. A formatted
conversation is one value of one row by its nature, so a conversation meets in one task; nothing larger does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"


def escape_text(text: Column) -> Column:
    """Make control strings harmless: backslashes are doubled, then `<|` becomes `<\\|`.

    Runs of backslashes from the text are even afterwards, so `<\\|` with one backslash is unambiguous.
    """
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape_text(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


#: What a role must not contain, since it ends at a line break and stands between control strings.
_ROLE_CODES = (("%", "%25"), ("\n", "%0A"), ("<", "%3C"), ("|", "%7C"))


def escape_role(role: Column) -> Column:
    for plain, code in _ROLE_CODES:
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def unescape_role(role: Column) -> Column:
    for plain, code in reversed(_ROLE_CODES):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages of each conversation: `conv_id`, `place` (from 1), `turn`, `role`, `text`.

    Events are taken by `seq`; ties by op, role and text, so the result does not depend on row order.
    Null text or role is empty; a null `seq` comes first, a null `op` is `message`, a null `turn` stands before
    all others and a null `conv_id` is a conversation of its own. Repeated `message` rows are messages of their
    own; other events of a turn change its latest message, or begin one where there is none. A message keeps the
    role of its first event. Extra columns are ignored. An empty log gives no rows.
    """
    rows = events.select(
        "conv_id",
        "turn",
        "seq",
        F.coalesce("op", F.lit("message")).alias("op"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).repartition("conv_id")
    order = (F.col("seq").asc_nulls_first(), F.col("op").desc(), "role", "text")
    begins = (F.col("op") == "message").cast("long")
    numbered = rows.withColumn(
        "event", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order))
    ).withColumn(
        "nth", F.greatest(F.sum(begins).over(Window.partitionBy("conv_id", "turn").orderBy("event")), F.lit(1))
    )
    # The text is that of the last event that sets it, and of the deltas since.
    messages = numbered.groupBy("conv_id", "turn", "nth").agg(
        F.coalesce(F.max(F.when(F.col("op") != "delta", F.col("event"))), F.lit(0)).alias("base"),
        F.max(F.when(F.col("op") == "regenerate", F.col("event"))).alias("again"),
        F.min_by("role", "event").alias("role"),
        F.array_sort(F.collect_list(F.struct("event", "text"))).alias("events"),
    )
    live = F.filter(F.col("events"), lambda e: e["event"] >= F.col("base"))
    before = Window.partitionBy("conv_id").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    place = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "nth")
    return (
        messages.withColumn("cut", F.max("again").over(before))
        .filter(F.col("cut").isNull() | (F.col("base") > F.col("cut")))
        .select(
            "conv_id",
            F.row_number().over(place).alias("place"),
            "turn",
            "role",
            F.array_join(F.transform(live, lambda e: e["text"]), "").alias("text"),
        )
    )


def render(messages: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per conversation: `conv_id`, `formatted`, `segments`.

    `formatted` holds the turns by `place`. `segments` cuts it into pieces of `text`, each with a `loss` flag; the
    flagged ones are the texts of `loss_role` and nothing else, so joined in order the pieces give `formatted`.
    """
    parts = messages.groupBy("conv_id").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "place",
                    F.concat(F.lit(TURN_START), escape_role(F.col("role")), F.lit("\n")).alias("head"),
                    escape_text(F.col("text")).alias("body"),
                    (F.col("role") == loss_role).alias("loss"),
                )
            )
        ).alias("parts")
    )

    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    no = F.lit(False)
    segments = F.flatten(
        F.transform(
            F.col("parts"),
            lambda p: F.array(piece(p["head"], no), piece(p["body"], p["loss"]), piece(F.lit(TURN_END), no)),
        )
    )
    whole = F.array_join(F.transform(F.col("parts"), lambda p: F.concat(p["head"], p["body"], F.lit(TURN_END))), "")
    return parts.select("conv_id", whole.alias("formatted"), segments.alias("segments"))


def format_events(events: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """Fold the log and render each conversation: `conv_id`, `formatted`, `segments`."""
    return render(fold_events(events), loss_role)


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of `role`, `text`."""
    end = "".join("\\" + c if c in "|" else c for c in TURN_END)
    blocks = F.split(formatted, end, -1)

    def turn(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        role = unescape_role(F.substr(head, F.lit(len(TURN_START) + 1)))
        return F.struct(role.alias("role"), unescape_text(F.substr(block, F.length(head) + 2)).alias("text"))

    return F.transform(F.slice(blocks, F.lit(1), F.size(blocks) - 1), turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, as it was before escaping."""
    return F.array_join(
        F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape_text(s["text"])), ""
    )


def message_events(conversations: DataFrame) -> DataFrame:
    """A table of finished turns as a log: each row is a `message` event, in turn order."""
    return conversations.select(
        "conv_id", "turn", F.col("turn").alias("seq"), F.lit("message").alias("op"), "role", "text"
    )
