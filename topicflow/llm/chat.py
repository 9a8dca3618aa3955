"""Chat formatting: a declarative template, a finite-state machine over roles, segments with loss flags.

Every turn becomes an opening marker, its text and a closing marker; the text of roles
under loss is what a model learns from.  Markers are control strings: where a text spells
one, a backslash goes after its first character (one more if there are some already), so
that none occurs inside a text, and taking one away restores the text.

All in DataFrame expressions.  One row per conversation comes out; its turns are gathered
for it, as its text is one string.

Turns go by turn number, then role and text, null first.  Null texts and roles are empty.
A role that the template does not name is written by name between the markers of `named`.
Rows without a conv_id form one conversation, repeated rows are repeated turns, other
columns are not read.  Invalid conversations are formatted like others, with `valid` false
and `first_bad` the place (from 0) of the first turn that breaks the order.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    opening: str
    closing: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Markers must begin with [ or < and have neither after that."""

    turns: dict[str, Turn]
    named: tuple[str, str, str]  # before the name of another role, after it, after the text
    moves: dict[str, tuple[str, ...]]  # the roles that may follow a role; `start` is before the first
    ends: tuple[str, ...]  # the roles that may be last
    markers: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        own = [m for t in self.turns.values() for m in (t.opening, t.closing)] + list(self.named)
        if any(not re.fullmatch(r"[\[<][^\[<\\]+", m) for m in own):
            raise ValueError("a marker begins with [ or < and has no such character, nor a backslash, after that")
        object.__setattr__(self, "markers", tuple(dict.fromkeys(own)))


INSTRUCT = Template(
    turns={
        "system": Turn("[SYS]", "[/SYS]"),
        "user": Turn("[INST]", "[/INST]"),
        "assistant": Turn("[ANS]", "</s>", loss=True),
    },
    named=("[ROLE]", "[IS]", "</s>"),
    moves={"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    ends=("assistant",),
)


def _tails(template: Template) -> str:
    return "|".join(re.escape(m[1:]) for m in template.markers)


def escape(text: Column, template: Template) -> Column:
    return F.regexp_replace(text, rf"([\[<])(\\*(?:{_tails(template)}))", r"$1\\$2")


def unescape(text: Column, template: Template) -> Column:
    return F.regexp_replace(text, rf"([\[<])\\(\\*(?:{_tails(template)}))", "$1$2")


def _by_role(role: Column, values: dict[str, str], other: Column) -> Column:
    out = other
    for name, value in values.items():
        out = F.when(role == name, F.lit(value)).otherwise(out)
    return out


def format_chats(rows: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """conv_id, segments (text, loss), formatted (all segments as one string), valid, first_bad."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = rows.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def segments(t: Column) -> Column:
        role = t["role"]
        name = F.concat(F.lit(template.named[0]), escape(role, template), F.lit(template.named[1]))
        opening = _by_role(role, {r: x.opening for r, x in template.turns.items()}, name)
        closing = _by_role(role, {r: x.closing for r, x in template.turns.items()}, F.lit(template.named[2]))
        loss = role.isin([r for r, x in template.turns.items() if x.loss])
        return F.array(
            F.struct(opening.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"], template).alias("text"), loss.alias("loss")),
            F.struct(closing.alias("text"), F.lit(False).alias("loss")),
        )

    moves = F.create_map(*(F.lit(x) for a, after in template.moves.items() for b in after for x in (f"{a}>{b}", b)))

    def step(state: Column, t: Column) -> Column:
        # The state is the last role; none is left after a wrong turn.
        to = F.coalesce(F.try_element_at(moves, F.concat(state["at"], F.lit(">"), t["role"])), F.lit(""))
        bad = F.when((state["bad"] < 0) & (to == ""), state["n"]).otherwise(state["bad"])
        return F.struct(to.alias("at"), (state["n"] + 1).alias("n"), bad.alias("bad"))

    start = F.struct(F.lit("start").alias("at"), F.lit(0).alias("n"), F.lit(-1).alias("bad"))
    done = chats.select("conv_id", F.flatten(F.transform("turns", segments)).alias("segments"), F.aggregate("turns", start, step).alias("s"))
    return done.select(
        "conv_id", "segments", F.concat_ws("", F.transform("segments", lambda s: s["text"])).alias("formatted"),
        ((F.col("s.bad") < 0) & F.col("s.at").isin(*template.ends)).alias("valid"),
        F.when(F.col("s.bad") >= 0, F.col("s.bad")).alias("first_bad"),
    )


def read_turns(formatted: Column, template: Template = INSTRUCT) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    named = rf"{re.escape(template.named[0])}.*?{re.escape(template.named[1])}"
    opening = "|".join([*(re.escape(t.opening) for t in template.turns.values()), named])
    closing = "|".join(re.escape(m) for m in dict.fromkeys([*(t.closing for t in template.turns.values()), template.named[2]]))
    pattern = F.lit(f"(?s)({opening})(.*?)(?:{closing})")
    first, last = len(template.named[0]), len(template.named[0]) + len(template.named[1])

    def turn(opened: Column, text: Column) -> Column:
        name = unescape(F.substring(opened, F.lit(first + 1), F.length(opened) - last), template)
        role = _by_role(opened, {}, name)
        for r, t in template.turns.items():
            role = F.when(opened == t.opening, F.lit(r)).otherwise(role)
        return F.struct(role.alias("role"), unescape(text, template).alias("text"))

    return F.zip_with(F.regexp_extract_all(formatted, pattern, F.lit(1)), F.regexp_extract_all(formatted, pattern, F.lit(2)), turn)


def loss_texts(segments: Column, template: Template = INSTRUCT) -> Column:
    """The texts under the loss mask, as they were before escaping."""
    return F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"], template))
