"""Chat transcripts from event logs, with loss masks; DataFrame functions only.

A conversation is a log of events: ``conv_id``, ``seq`` (their order), ``kind``,
``message`` (which message of the conversation), ``role`` and ``text``.

* ``open`` begins a message with its role and its first text;
* ``delta`` appends to the message, as streamed answers arrive;
* ``edit`` replaces the text so far;
* ``regenerate`` drops the text so far, and all messages after this one as they were.

Logs are folded into final messages, and those rendered with a template:
``<|im_start|>role``, a line feed, the text, ``<|im_end|>``, a line feed. Inside
roles and texts ``&`` becomes ``&amp;`` and ``<|`` becomes ``&lt;|``, so that
what looks like a mark always is one, and everything can be read back.

Defined results: a null text is empty, a null role too; events with a null
``seq`` or ``message`` come first; a null ``conv_id`` is a conversation; events
equal in ``seq`` apply in the order of kinds above, then of text; an unknown kind
fails the job; an empty log gives no rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The marks of the template and their escapes, the role that is learnt.
START = "<|im_start|>"
END = "<|im_end|>\n"
ASSISTANT = "assistant"
KINDS = ("open", "delta", "edit", "regenerate")


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def _escaped_role(role: Column) -> Column:
    """A role on one line: line feeds too have an escape."""
    return F.replace(escape(role), F.lit("\n"), F.lit("&nl;"))


def _unescaped_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&nl;"), F.lit("\n")))


def messages(events: DataFrame) -> DataFrame:
    """The final messages of all logs: ``conv_id``, ``message``, ``role``, ``text``.

    Texts are put together message by message, so a long conversation is many
    groups until it is rendered.
    """
    kind = F.when(F.col("kind").isin(*KINDS), F.col("kind")).otherwise(
        F.raise_error(F.concat(F.lit("unknown kind of event: "), F.coalesce("kind", F.lit("(null)"))))
    )
    rank = F.array_position(F.array(*map(F.lit, KINDS)), kind).cast("int")
    event = F.struct("seq", rank.alias("rank"), F.coalesce("text", F.lit("")).alias("text"), "role")
    grouped = events.groupBy("conv_id", "message").agg(
        F.array_sort(F.collect_list(event)).alias("events"),
        F.max(F.when(kind == "regenerate", F.struct("seq", rank.alias("rank")))).alias("_again"),
    )
    # What the regenerations of this and all earlier messages leave standing.
    earlier = Window.partitionBy("conv_id").orderBy("message").rangeBetween(Window.unboundedPreceding, 0)
    cut = grouped.withColumn("_cut", F.max("_again").over(earlier))
    standing = F.filter(
        "events", lambda e: F.col("_cut").isNull() | (F.struct(e["seq"], e["rank"]) >= F.col("_cut"))
    )
    named = F.filter("events", lambda e: e["role"].isNotNull())
    role = F.array_max(F.transform(named, lambda e: F.struct(e["seq"], e["rank"], e["role"])))
    live = cut.withColumns({"_live": standing, "_role": role["role"]}).where(F.size("_live") > 0)
    # The text begins at the last event that is no delta.
    begins = F.array_max(F.transform("_live", lambda e, i: F.when(e["rank"] != 2, i).otherwise(0)))
    texts = F.transform(
        F.slice("_live", begins + 1, F.size("_live")),
        lambda e: F.when(e["rank"] == 4, F.lit("")).otherwise(e["text"]),
    )
    return live.select(
        "conv_id",
        "message",
        F.coalesce("_role", F.lit("")).alias("role"),
        F.array_join(texts, "").alias("text"),
    )


def render(final: DataFrame) -> DataFrame:
    """One row for each conversation: ``formatted`` and ``segments``.

    ``segments`` are pieces of ``text`` that together are ``formatted``, each with
    ``loss``: true for the texts of assistants.
    """
    turns = final.select(
        "conv_id",
        F.struct(
            "message", _escaped_role(F.col("role")).alias("role"), escape(F.col("text")).alias("text")
        ).alias("turn"),
    )
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))

    def pieces(turn):
        head = F.concat(F.lit(START), turn["role"], F.lit("\n"))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(turn["text"].alias("text"), (turn["role"] == ASSISTANT).alias("loss")),
            F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")),
        )

    rendered = grouped.withColumn("segments", F.flatten(F.transform("turns", pieces)))
    return rendered.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
    )


def loss_spans(rendered: DataFrame) -> DataFrame:
    """A row for each span under the loss mask: ``conv_id``, ``start`` and ``stop`` in characters of ``formatted``."""
    pieces = rendered.select("conv_id", F.posexplode("segments").alias("place", "segment")).select(
        "conv_id", "place", F.length("segment.text").cast("bigint").alias("size"), "segment.loss"
    )
    up_to = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    placed = pieces.withColumn("stop", F.sum("size").over(up_to))
    return placed.where("loss").select("conv_id", (F.col("stop") - F.col("size")).alias("start"), "stop")


def read_back(rendered: DataFrame) -> DataFrame:
    """``rendered`` with ``turns``, the roles and texts found in ``formatted``, and ``loss_text``.

    ``loss_text`` is what stands under the mask, unescaped, one text after the other.
    """
    parts = F.split(F.col("formatted"), r"<\|im_end\|>\n")
    parts = F.slice(parts, 1, F.size(parts) - 1)
    turns = F.transform(
        parts,
        lambda p: F.struct(
            _unescaped_role(F.substring_index(F.substr(p, F.lit(len(START) + 1)), "\n", 1)).alias("role"),
            unescape(F.substr(p, F.locate("\n", p) + 1)).alias("text"),
        ),
    )
    masked = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    return rendered.withColumns({"turns": turns, "loss_text": F.array_join(masked, "")})


def as_events(turns: DataFrame) -> DataFrame:
    """The log of a table of whole turns (``conv_id``, ``turn``, ``role``, ``text``).

    Each turn opens a message and streams its text in two deltas. Before that, by
    the hash of conversation and turn, some had another text: one in four streams a
    first draft, which an edit with the text's beginning replaces; one in four
    answers is streamed in other words and then regenerated. Rows that share their
    turn are messages of their own, in the order of role and text.
    """
    text = F.coalesce("text", F.lit(""))
    same = Window.partitionBy("conv_id", "turn").orderBy("role", "_text")
    half = F.expr("int(length(_text) / 2)")
    numbered = turns.select("conv_id", "turn", "role", text.alias("_text")).withColumn(
        "_copy", F.row_number().over(same)
    )

    def event(place, kind, role, text):
        return F.struct(F.lit(place).alias("place"), F.lit(kind).alias("kind"), role.alias("role"), text.alias("text"))

    nobody, begin, end = F.lit(None).cast("string"), F.substr("_text", F.lit(1), half), F.substr("_text", half + 1)
    draft = F.reverse("_text")
    drawn = F.pmod(F.xxhash64("conv_id", "turn", "_copy"), F.lit(4))
    opened = event(0, "open", F.col("role"), F.lit(""))
    last = event(5, "delta", nobody, end)
    streamed = F.array(opened, event(4, "delta", nobody, begin), last)
    edited = F.array(opened, event(1, "delta", nobody, draft), event(3, "edit", nobody, begin), last)
    again = F.array(
        opened, event(1, "delta", nobody, draft), event(2, "delta", nobody, F.lit(" (unfinished")),
        event(3, "regenerate", nobody, F.lit("")), event(4, "delta", nobody, begin), last,
    )
    answer = F.col("role").eqNullSafe(F.lit(ASSISTANT))
    events = F.when(drawn == 0, edited).when((drawn == 1) & answer, again).otherwise(streamed)
    return numbered.select(
        "conv_id", F.struct("turn", "_copy").alias("message"), F.explode(events).alias("e")
    ).select(
        "conv_id",
        F.struct("message.turn", "message._copy", "e.place").alias("seq"),
        "e.kind",
        "message",
        "e.role",
        "e.text",
    )


def format_logs(events: DataFrame) -> DataFrame:
    """``render`` of the ``messages`` of all logs."""
    return render(messages(events))
