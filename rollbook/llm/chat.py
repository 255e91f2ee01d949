"""Chat formatting from event logs.

A conversation is a log of events in sequence: a message starts, streamed deltas are appended to it, an
edit replaces its text, a regeneration throws away its text and every later message begun before that.
The log is folded into final messages, which are rendered with a template; spans of the loss mask are
given in code points of the rendered text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Marks of the template.
START = "<|im_start|>"
END = "<|im_end|>"
LOSS_ROLE = "assistant"
EVENTS = ("start", "delta", "edit", "regenerate")


def escape_text(text: Column) -> Column:
    """No ``<|`` is left: a backslash goes in after each ``<`` that backslashes (or none) and ``|`` follow."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<(\\*)\|", r"<\\$1|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    """One line without marks; reversible."""
    out = F.coalesce(role, F.lit(""))
    for raw, code in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        out = F.replace(out, F.lit(raw), F.lit(code))
    return out


def unescape_role(role: Column) -> Column:
    for raw, code in (("<", "%3C"), ("\n", "%0A"), ("%", "%25")):
        role = F.replace(role, F.lit(code), F.lit(raw))
    return role


def message_events(messages: DataFrame) -> DataFrame:
    """Messages (``conv_id, turn, role, text``) as a log that comes to each text by every kind of event.

    A message starts and streams a draft; the next one starts on it; a regeneration throws both away; a wrong
    delta follows, an edit puts the first half in its place, and the second half is streamed. Rows of a
    conversation are ordered by turn (null first), then role and text, so repeated rows are messages of their
    own. Null text is empty. Messages have even numbers, those thrown away the odd one after.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    text = F.coalesce("text", F.lit(""))
    half = F.floor(F.char_length(text) / 2).cast("int")
    first, second = F.substring(text, F.lit(1), half), F.substring(text, half + 1, F.char_length(text))
    steps = [
        ("start", 0, F.lit("")), ("delta", 0, second), ("start", 1, F.lit("")), ("delta", 1, F.lit("draft")),
        ("regenerate", 0, F.lit("")), ("delta", 0, F.lit("wrong")), ("edit", 0, first), ("delta", 0, second),
    ]
    event = lambda n, kind, k, t: F.struct(F.lit(n).alias("n"), F.lit(kind).alias("event"), F.lit(k).alias("k"), t.alias("text"))
    numbered = messages.select("conv_id", "role", "text", (F.row_number().over(order) * 2).cast("long").alias("msg"))
    logged = numbered.select("conv_id", "role", "msg", F.explode(F.array(*[event(n, *s) for n, s in enumerate(steps)])).alias("e"))
    seq = F.col("msg") * len(steps) + F.col("e.n")
    return logged.select("conv_id", seq.alias("seq"), "e.event", (F.col("msg") + F.col("e.k")).alias("msg"), "role", "e.text")


def fold_messages(log: DataFrame) -> DataFrame:
    """Final messages ``conv_id, msg, role, text`` of a log ``conv_id, seq, event, msg, role, text``.

    The text of a message is what its deltas and edits after its last edit or regeneration give, in
    sequence; events with one sequence number are taken in the order edit, other, then by text. A message
    goes if an earlier one was regenerated after it began. Its role is that of its last start event that
    has one. Null text adds nothing; unknown events are ignored; null seq comes first, null conv_id is a
    conversation. Messages are ordered by ``msg``, null first. Repeated delta rows are repeated text.
    """
    seq = F.coalesce("seq", F.lit(-(2**62)))
    kind = F.col("event")
    text = F.coalesce("text", F.lit(""))
    per_message = log.filter(kind.isin(*EVENTS)).groupBy("conv_id", "msg").agg(
        F.min(seq).alias("began"),
        F.max(F.when(kind == "start", seq)).alias("started"),
        F.max(F.when(kind.isin("edit", "regenerate"), seq)).alias("reset"),
        F.max(F.when(kind == "regenerate", seq)).alias("again"),
        F.max(F.when((kind == "start") & F.col("role").isNotNull(), F.struct(seq.alias("s"), "role"))).alias("named"),
        F.collect_list(
            F.when(kind.isin("delta", "edit"), F.struct(seq.alias("s"), (kind != "edit").alias("n"), text.alias("t")))
        ).alias("parts"),
    )
    earlier = Window.partitionBy("conv_id").orderBy("msg").rowsBetween(Window.unboundedPreceding, -1)
    # Of several edits with the last sequence number the greatest text counts.
    reset = F.coalesce("reset", F.lit(-(2**62)))
    live = F.sort_array(F.filter("parts", lambda p: p["s"] >= reset))
    edits = F.array_max(F.filter("parts", lambda p: (p["s"] == reset) & ~p["n"])["t"])
    rest = F.array_join(F.transform(F.filter(live, lambda p: p["n"]), lambda p: p["t"]), "")
    return (
        per_message.withColumn("above", F.max("again").over(earlier))
        .filter(F.col("above").isNull() | (F.col("above") < F.coalesce("started", "began")))
        .select("conv_id", "msg", F.col("named.role").alias("role"), F.concat(F.coalesce(edits, F.lit("")), rest).alias("text"))
    )


def render(messages: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """A row per conversation: ``conv_id, n_turns, formatted, loss_spans``.

    ``formatted`` is ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n`` per message, control strings in role and text
    escaped; ``loss_spans`` are (start, length) in code points, from 0, of the texts of ``loss_role``.
    """
    role, text = escape_role(F.col("role")), escape_text(F.col("text"))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    turn = F.struct(
        "msg",
        F.concat(head, text, F.lit(f"{END}\n")).alias("shown"),
        F.char_length(head).cast("long").alias("skip"),
        F.char_length(text).cast("long").alias("chars"),
        F.coalesce(F.col("role") == loss_role, F.lit(False)).alias("loss"),
    )
    turns = messages.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    place = F.lit(0).cast("long")
    ends = len(END) + 1
    # Fold: running place in code points, and the spans met so far.
    state = F.struct(place.alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(s, t):
        span = F.struct((s["at"] + t["skip"]).alias("start"), t["chars"].alias("length"))
        return F.struct(
            (s["at"] + t["skip"] + t["chars"] + ends).alias("at"),
            F.when(t["loss"], F.concat(s["spans"], F.array(span))).otherwise(s["spans"]).alias("spans"),
        )

    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["shown"]), "").alias("formatted"),
        F.aggregate("turns", state, step)["spans"].alias("loss_spans"),
    )


def format_log(log: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """Fold a log and render its conversations."""
    return render(fold_messages(log), loss_role)


def parse(formatted: Column) -> Column:
    """Messages (role, text) read back from a rendered conversation. Inside texts no mark can stand, so
    the rendered text is cut at its start marks."""
    pieces = F.slice(F.split(formatted, r"<\|im_start\|>"), F.lit(2), F.greatest(F.size(F.split(formatted, r"<\|im_start\|>")) - 1, F.lit(0)))
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
            unescape_text(
                F.substring(
                    p,
                    F.locate("\n", p) + 1,
                    F.char_length(p) - F.locate("\n", p) - (len(END) + 1),
                )
            ).alias("text"),
        ),
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(
            spans, lambda s: unescape_text(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
        ),
        "",
    )
