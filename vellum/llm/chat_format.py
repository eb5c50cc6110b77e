"""Chat formatting: a machine over roles checks turn order, a template renders.

The template is data: which role may follow which, which may end, and for each
role the marks around its text and whether the text counts for the loss.
``format_segments`` emits one row per text segment with its loss flag;
``render`` joins a conversation's segments and keeps the loss spans as offsets;
``read_back`` recovers turns and loss text from the rendered string alone.

Control strings inside texts are quoted by one backslash after their first
character; a string already quoted gets one more.  Taking one away undoes it,
and texts without control strings stay as they are.

Defined results: null text is empty and null role is the role ''; roles outside
the template get a generic mark and make the conversation invalid, as does a
wrong order, but are formatted all the same.  Rows order by turn (null first),
equal turns by role, then text; repeated rows are turns of their own.  A null
conv_id is a conversation like any other.  An empty table gives an empty result.
Only conv_id, turn, role and text are read, so extra columns can't clash.

A conversation is rendered into one string (that is the result), so a single
conversation must fit one row; its segments are ordered by a window over
narrow, spillable rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


class Mark(NamedTuple):
    opens: str
    closes: str
    loss: bool


class ChatTemplate(NamedTuple):
    marks: dict[str, Mark]
    start: str
    moves: dict[str, tuple[str, ...]]
    accepts: tuple[str, ...]


INST = ChatTemplate(
    marks={
        "system": Mark("<<SYS>>", "<</SYS>>", False),
        "user": Mark("[INST]", "[/INST]", False),
        "assistant": Mark("<s>", "</s>", True),
    },
    start="^",
    moves={"^": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    accepts=("assistant",),
)

# Marks of roles that the template doesn't name hold the role URL-encoded; the
# empty role is written as a bare %, which the encoding never gives.
OTHER = r"\|/?[A-Za-z0-9.*_+%-]+\|>"


def _quote(s: str) -> str:
    return "".join("\\" + c if c in "[]|/<>.*+?(){}^$\\" else c for c in s)


def _tails(t: ChatTemplate) -> str:
    """Control strings without their first character, as alternatives."""
    return "|".join([*(_quote(s[1:]) for m in t.marks.values() for s in (m.opens, m.closes)), OTHER])


def escape(text: Column, t: ChatTemplate) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({_tails(t)})", r"$1\\$2$3")


def unescape(text: Column, t: ChatTemplate) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({_tails(t)})", r"$1$2$3")


def _by_role(role: Column, t: ChatTemplate, known, other: Column) -> Column:
    out = None
    for name, mark in t.marks.items():
        out = (F if out is None else out).when(role == name, F.lit(known(mark)))
    return out.otherwise(other)


def format_segments(turns: DataFrame, t: ChatTemplate = INST) -> DataFrame:
    """One row per segment: conv_id, turn_no, part (0 mark, 1 text, 2 mark), segment, loss, ok.

    ``ok`` is the machine's verdict on the move into the segment's turn.
    """
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    moves = [f"{a}>{b}" for a, to in t.moves.items() for b in to]
    name = F.when(F.col("role") == "", F.lit("%")).otherwise(F.url_encode("role"))
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select(
        "conv_id", "role", "text", (F.row_number().over(order) - 1).alias("turn_no"),
        F.concat_ws(">", F.lag("role", 1, t.start).over(order), "role").isin(moves).alias("ok"))
    opens = _by_role(F.col("role"), t, lambda m: m.opens, F.concat(F.lit("<|"), name, F.lit("|>")))
    closes = _by_role(F.col("role"), t, lambda m: m.closes, F.concat(F.lit("<|/"), name, F.lit("|>")))
    loss = _by_role(F.col("role"), t, lambda m: m.loss, F.lit(False))
    segment = lambda k, text, flag: F.struct(F.lit(k).alias("part"), text.alias("segment"), flag.alias("loss"))
    return rows.select("conv_id", "turn_no", "role", "ok", F.inline(F.array(
        segment(0, F.concat(opens, F.lit(" ")), F.lit(False)),
        segment(1, escape(F.col("text"), t), loss),
        segment(2, F.concat(F.lit(" "), closes, F.lit("\n")), F.lit(False)))))


def render(segments: DataFrame, t: ChatTemplate = INST) -> DataFrame:
    """One row per conversation: formatted string, loss spans (start, length in code points; ``masks`` has
    one per turn, from the turn's own start, null without loss), verdict."""
    so_far = W.partitionBy("conv_id").orderBy("turn_no", "part").rowsBetween(W.unboundedPreceding, -1)
    in_turn = W.partitionBy("conv_id", "turn_no").orderBy("part")
    placed = segments.withColumn("start", F.coalesce(F.sum(F.length("segment")).over(so_far), F.lit(0)))
    placed = placed.withColumn("within", F.col("start") - F.first("start").over(in_turn))
    grouped = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn_no", "part", "segment", "loss", "start", "within"))).alias("s"),
        F.min(F.when(~F.col("ok"), F.col("turn_no"))).alias("first_bad_turn"),
        F.max_by("role", "turn_no").alias("last_role"))
    spans = F.transform(F.filter("s", lambda x: x["loss"]), lambda x: F.struct(
        x["start"].cast("int").alias("start"), F.length(x["segment"]).alias("length")))
    masks = F.transform(F.filter("s", lambda x: x["part"] == 1), lambda x: F.when(x["loss"], F.struct(
        x["within"].cast("int").alias("start"), F.length(x["segment"]).alias("length"))))
    return grouped.select(
        "conv_id", F.array_join(F.transform("s", lambda x: x["segment"]), "").alias("formatted"),
        spans.alias("loss_spans"), masks.alias("masks"), "first_bad_turn",
        (F.col("first_bad_turn").isNull() & F.col("last_role").isin(list(t.accepts))).alias("valid"))


def read_back(rendered: DataFrame, t: ChatTemplate = INST) -> DataFrame:
    """conv_id, turns (role, text) and loss_text, from the rendered string and its masks."""
    opens = "|".join([*(_quote(m.opens) for m in t.marks.values()), r"<\|[A-Za-z0-9.*_+%-]+\|>"])
    closes = "|".join([*(_quote(m.closes) for m in t.marks.values()), r"<\|/[A-Za-z0-9.*_+%-]+\|>"])
    turn = F.lit(rf"(?s)(?:{opens}) .*? (?:{closes})\n")
    named = F.create_map(*(F.lit(x) for name, m in t.marks.items() for x in (m.opens, name)))

    def role(mark: Column) -> Column:
        inner = F.regexp_replace(mark, r"^<\||\|>$", "")
        return F.coalesce(F.get(F.array(named[mark]), F.lit(0)),
                          F.when(inner == "%", F.lit("")).otherwise(F.url_decode(inner)))

    # marks hold no space, so a turn's first and last space bound its text
    pieces = F.regexp_extract_all("formatted", turn, F.lit(0))
    text = lambda x: F.substring(
        x, F.length(F.substring_index(x, " ", 1)) + 2,
        F.length(x) - F.length(F.substring_index(x, " ", 1)) - F.length(F.substring_index(x, " ", -1)) - 2)
    return rendered.select(
        "conv_id", "formatted", "valid", "first_bad_turn",
        F.transform(pieces, lambda x: F.struct(role(F.substring_index(x, " ", 1)).alias("role"), unescape(text(x), t).alias("text"))).alias("turns"),
        F.array_join(F.zip_with(pieces, "masks", lambda x, m: F.when(m.isNotNull(), unescape(
            F.substring(x, m["start"] + 1, m["length"]), t))), "").alias("loss_text"))


def digests(read: DataFrame) -> DataFrame:
    """The contract's digest columns of what was read back."""
    flat = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid", "first_bad_turn")
