"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; neighbouring
turns of one role become one run, whose texts are joined; runs are
concatenated. Nothing is lost: control strings inside texts are escaped, run
parts are told apart by a marker, and `read_back` recovers every turn from the
formatted string alone.

Defined results: a null text is empty; a null role is the empty role; null
turns come first; equal turns are ordered by role, then text; repeated rows are
repeated turns; rows without a conv_id form one conversation of their own; other
columns are ignored; an empty table gives an empty result. A conversation is one
output value, so its text must fit one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How a run opens and closes, by role. Any other role is written out.
MARKS = {"system": ("<<SYS>> ", " <</SYS>>"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>")}
OTHER_OPEN, OTHER_TEXT, OTHER_CLOSE = "<|role|>", "<|text|>", "<|end|>"
PART = "<|part|>"
LEARNED_ROLE = "assistant"

# A control string is one of these openings and one of these endings. Inside
# texts a backslash is put between the two; text that already has backslashes
# there gets one more, so the way back is unique.
_ENDINGS = r"s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|\|role\|>|\|text\|>|\|end\|>|\|part\|>"
ESCAPE_PATTERN = rf"([<\[])(\\*)({_ENDINGS})"
UNESCAPE_PATTERN = rf"([<\[])\\(\\*)({_ENDINGS})"
_AFTER_RUN = r"(?<=</s>|\[/INST\]|<</SYS>>|<\|end\|>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(ESCAPE_PATTERN), F.lit(r"$1\\$2$3"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(UNESCAPE_PATTERN), F.lit("$1$2$3"))


def _by_role(role: Column, known: int, other: Column) -> Column:
    mark = F.lit(None).cast("string")
    for name, marks in MARKS.items():
        mark = F.when(role == name, F.lit(marks[known])).otherwise(mark)
    return F.coalesce(mark, other)


def _runs(turns: Column) -> Column:
    """array<struct<role, parts array<string>>>: neighbours of one role
    together, found by where the role changes, so the cost is linear."""
    n = F.size(turns)
    role_at = lambda i: F.get(turns, i - 1)["role"]
    starts = F.filter(F.sequence(F.lit(1), n), lambda i: (i == 1) | (role_at(i) != role_at(i - 1)))
    ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(n + 1))
    return F.transform(
        F.arrays_zip(starts.alias("a"), ends.alias("b")),
        lambda r: F.struct(
            role_at(r["a"]).alias("role"),
            F.transform(F.slice(turns, r["a"], r["b"] - r["a"]), lambda t: escape(t["text"])).alias("parts"),
        ),
    )


def _pieces(run: Column) -> Column:
    """A run as array<struct<text, loss>>, in order."""
    role = run["role"]
    plain = lambda c: F.struct(c.alias("text"), F.lit(False).alias("loss"))
    learned = role == LEARNED_ROLE
    head = _by_role(role, 0, F.concat(F.lit(OTHER_OPEN), escape(role), F.lit(OTHER_TEXT)))
    parts = F.flatten(F.transform(run["parts"], lambda p, i: F.array(
        plain(F.when(i > 0, F.lit(PART)).otherwise(F.lit(""))),
        F.struct(p.alias("text"), learned.alias("loss")),
    )))
    return F.concat(F.array(plain(head)), parts, F.array(plain(_by_role(role, 1, F.lit(OTHER_CLOSE)))))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, and segments: array<struct<chars, loss>> whose
    lengths in code points cover `formatted` from start to end."""
    turns = conversations.select(
        "conv_id", "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    collected = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    runs = collected.select("conv_id", _runs(F.col("turns")).alias("runs"))
    pieces = runs.select("conv_id", F.flatten(F.transform("runs", _pieces)).alias("pieces"))
    return pieces.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"),
        F.transform("pieces", lambda p: F.struct(F.length(p["text"]).alias("chars"), p["loss"].alias("loss"))).alias("segments"),
    )


def loss_spans(segments: Column) -> Column:
    """array<struct<start, end>> (code points, end exclusive) under the mask."""
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans"))
    return F.aggregate(segments, start, lambda acc, s: F.struct(
        (acc["at"] + s["chars"]).alias("at"),
        F.when(
            s["loss"],
            F.concat(acc["spans"], F.array(F.struct(acc["at"].alias("start"), (acc["at"] + s["chars"]).alias("end")))),
        ).otherwise(acc["spans"]).alias("spans"),
    ))["spans"]


def _read_run(run: Column) -> Column:
    """The turns of one formatted run."""
    inner = F.substring(run, F.lit(len(OTHER_OPEN) + 1), F.length(run) - len(OTHER_OPEN) - len(OTHER_CLOSE))
    name = F.substring_index(inner, OTHER_TEXT, 1)
    role, body = unescape(name), F.substring(inner, F.length(name) + len(OTHER_TEXT) + 1, F.length(inner))
    for known, (head, tail) in MARKS.items():
        here = F.startswith(run, F.lit(head))
        role = F.when(here, F.lit(known)).otherwise(role)
        body = F.when(
            here, F.substring(run, F.lit(len(head) + 1), F.length(run) - len(head) - len(tail))
        ).otherwise(body)
    return F.transform(
        F.split(body, r"<\|part\|>", -1), lambda p: F.struct(role.alias("role"), unescape(p).alias("text")))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns array<struct<role, text>> and learned (all text under the
    loss mask, unescaped), both recovered from the formatted string."""
    runs = F.filter(F.split("formatted", _AFTER_RUN, -1), lambda r: r != "")
    cut = F.transform(
        loss_spans(F.col("segments")),
        lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])),
    )
    return formatted.select(
        "conv_id", "formatted",
        F.flatten(F.transform(runs, _read_run)).alias("turns"),
        F.array_join(cut, "").alias("learned"),
    )
