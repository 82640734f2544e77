"""Chat formatting from a declarative template. DataFrame functions only.

A template names the roles, the marks around a turn, which roles are under the loss, and the moves of a
finite-state machine over roles. A conversation becomes one training sample: text segments, each with its
loss flag, whose texts in order are the formatted text. Control strings inside texts are escaped: the escape
mark goes before each, and the marks that stood there are doubled; so an odd number of marks before a control
string always means text, and the original comes back exactly.

A conversation is one sample and so one row; its turns meet in one task. Nothing else is gathered.

Defined results
* turns are ordered by turn (null first), then role, then text; equal rows are all kept.
* null text is an empty text, a null role the role "null"; a role that the template doesn't know has a
  turn of its own, outside the loss, and makes the conversation invalid.
* ``valid`` says whether the machine accepts the roles; ``error_turn`` is the index of the first turn that it refuses
  (the number of turns, when the end is refused; null when valid). Invalid conversations are formatted too.
* very long texts and runs of escape marks take time linear in their length.
* null conv_id is a conversation. An empty table gives an empty table. Other columns are left out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import checked


#: Before the name of a role that the template doesn't know.
OTHER = "%:"


@dataclass(frozen=True)
class Template:
    """What a turn looks like, and which turn may follow which."""

    head: str = "### {role}:\n"
    tail: str = "\n</turn>\n"
    names: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    loss: tuple[str, ...] = ("assistant",)
    #: state and role to state; a missing pair is refused.
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "ready",
            ("start", "user"): "asked",
            ("ready", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )
    final: tuple[str, ...] = ("asked", "answered")
    mark: str = "\\"

    def controls(self) -> str:
        """A pattern of the strings that only the template may write as they are."""
        heads = [f"### {n}:" for n in self.names.values()]
        return "|".join(re.escape(x).replace("\\ ", " ") for x in [*heads, "</turn>"])


def escaped(text: Column, t: Template) -> Column:
    m = re.escape(t.mark)
    # a run of marks is tried once, from its first mark, and without going back: linear in its length
    return F.regexp_replace(text, f"(?<!{m})({m}*+)({t.controls()})", "$1$1" + ("\\\\" if t.mark == "\\" else t.mark) + "$2")


def unescaped(text: Column, t: Template) -> Column:
    # the marks at the end of what stands before a control string, without the last one, are halved
    pieces, controls = F.split(text, t.controls(), -1), F.regexp_extract_all(text, F.lit(f"({t.controls()})"), F.lit(1))

    def plain(piece: Column, i: Column) -> Column:
        rest = F.rtrim(piece, F.lit(t.mark))
        marks = F.length(piece) - F.length(rest)
        halved = F.when(marks % 2 == 1, F.concat(rest, F.repeat(F.lit(t.mark), ((marks - 1) / 2).cast("int")))).otherwise(piece)
        return F.when(i < F.size(controls), F.concat(halved, F.get(controls, i))).otherwise(piece)

    return F.array_join(F.transform(pieces, plain), "")


def format_chat(turns: DataFrame, template: Template | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each conversation: conv, valid, error_turn, segments (text, loss), formatted."""
    t = template or Template()
    rows = checked(turns, conv, turn, role, text).select(
        F.col(f"`{conv}`").alias("_conv"), F.col(f"`{turn}`").alias("_turn"), F.coalesce(F.col(f"`{role}`"), F.lit("null")).alias("_role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text")
    )
    names = F.create_map(*[F.lit(x) for kv in t.names.items() for x in kv])
    before, after = t.head.split("{role}")
    known = F.try_element_at(names, F.col("_role"))
    rows = rows.select(
        "_conv",
        F.struct(
            "_turn",
            "_role",
            F.col("_text").alias("raw"),
            F.concat(F.lit(before), F.coalesce(known, F.concat(F.lit(OTHER), F.regexp_replace(F.regexp_replace("_role", "%", "%25"), "\n", "%0A"))), F.lit(after)).alias("head"),
            escaped(F.col("_text"), t).alias("body"),
        ).alias("x"),
    )
    convs = rows.groupBy("_conv").agg(F.sort_array(F.collect_list("x")).alias("_turns"))
    moves = F.create_map(*[F.lit(x) for (s, r), to in t.moves.items() for x in (f"{s}\t{r}", to)])
    step = F.aggregate(
        "_turns",
        F.struct(F.lit("start").alias("state"), F.lit(0).alias("n"), F.lit(None).cast("int").alias("bad")),
        lambda acc, x: F.struct(
            F.coalesce(F.try_element_at(moves, F.concat_ws("\t", acc["state"], x["_role"])), F.lit("refused")).alias("state"),
            (acc["n"] + 1).alias("n"),
            F.coalesce(acc["bad"], F.when(F.try_element_at(moves, F.concat_ws("\t", acc["state"], x["_role"])).isNull(), acc["n"])).alias("bad"),
        ),
    )
    segments = F.flatten(
        F.transform(
            "_turns",
            lambda x: F.array(
                F.struct(x["head"].alias("text"), F.lit(False).alias("loss")),
                F.struct(x["body"].alias("text"), x["_role"].isin(*t.loss).alias("loss")),
                F.struct(F.lit(t.tail).alias("text"), F.lit(False).alias("loss")),
            ),
        )
    )
    return (
        convs.select("_conv", step.alias("_fsm"), segments.alias("segments"))
        .withColumn("error_turn", F.coalesce(F.col("_fsm.bad"), F.when(~F.col("_fsm.state").isin(*t.final), F.col("_fsm.n"))))
        .select(F.col("_conv").alias(conv), F.col("error_turn").isNull().alias("valid"), "error_turn", "segments", F.array_join(F.col("segments.text"), "").alias("formatted"))
    )


def read_chat(formatted: Column, template: Template | None = None) -> Column:
    """The turns of a formatted text, read back from it: an array of (role, text)."""
    t = template or Template()
    before, after = t.head.split("{role}")
    roles = F.create_map(*[F.lit(x) for k, v in t.names.items() for x in (v, k)])
    parts = F.split(formatted, re.escape(t.tail).replace("\\\n", "\n"), -1)

    def turn(part: Column) -> Column:
        cut = F.instr(part, after)
        name = F.substring(part, F.lit(len(before) + 1), cut - len(before) - 1)
        body = F.substring(part, cut + len(after), F.length(part))
        other = F.regexp_replace(F.regexp_replace(F.substring(name, len(OTHER) + 1, 2**31 - 1), "%0A", "\n"), "%25", "%")
        return F.struct(F.coalesce(F.try_element_at(roles, name), other).alias("role"), unescaped(body, t).alias("text"))

    return F.transform(F.slice(parts, 1, F.size(parts) - 1), turn)
