"""Chat formatting: a finite-state machine over roles, and a reversible declarative template.

All of it is DataFrame expressions. A conversation's turns are put in order, walked by the
machine, and written as segments of text, each with a flag that says whether its text counts
for the training loss. Control strings inside roles and texts are escaped, so that the
formatted text can be read back turn by turn.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """How a turn is written, which roles are learned, and which role may follow which.

    ``moves`` maps a state to the roles it accepts and the state each leads to; ``final`` are
    the states in which a conversation may end. The three marks must hold no escape sign, be of
    two characters at least, and differ from one another.
    """

    opening: str = "### "
    naming: str = ": "
    closing: str = " </turn>\n"
    #: Never left unbroken inside a role or a text.
    control: tuple[str, ...] = ("###", "</turn>")
    learned: frozenset[str] = frozenset({"assistant"})
    start: str = "start"
    final: frozenset[str] = frozenset({"asked", "answered"})
    moves: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "told", "user": "asked"},
            "told": {"user": "asked"},
            "asked": {"assistant": "answered"},
            "answered": {"user": "asked"},
        }
    )


def escaped(text: Column, control: tuple[str, ...]) -> Column:
    """Double the escape sign, and put one behind the first character of each control string."""
    text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    for c in control:
        text = F.regexp_replace(text, f"{re.escape(c[0])}(?={re.escape(c[1:])})", c[0] + ESCAPE * 2)
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _walk(turns: Column, t: Template) -> Column:
    """The machine's state after all turns; null once a role was not accepted."""
    arcs = [x for s, to in t.moves.items() for r, n in to.items() for x in (F.lit(f"{s} {r}"), F.lit(n))]
    table = F.create_map(*arcs)
    return F.aggregate(
        turns, F.lit(t.start), lambda s, x: F.try_element_at(table, F.concat_ws(" ", s, x["role"])), lambda s: s
    )


def formatted(
    df: DataFrame, template: Template = Template(), conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: ``segments`` (text, loss), ``formatted`` and ``valid``.

    Turns are ordered by ``turn``, ties by role and text; a null turn comes first, a null role or
    text counts as empty, and rows with a null conversation form one conversation. Repeated rows
    are repeated turns. Other columns are not looked at. ``valid`` says whether the roles follow
    the machine to a final state; conversations that do not are formatted all the same. An empty
    table gives an empty one.
    """
    t = template
    rows = df.select(
        F.col(conv).alias(conv),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("t"),
    )
    turns = rows.groupBy(conv).agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def segment(text: Column | str, loss: Column | bool) -> Column:
        of = lambda x: x if isinstance(x, Column) else F.lit(x)
        return F.struct(of(text).alias("text"), of(loss).alias("loss"))

    def written(x: Column) -> Column:
        name = escaped(x["role"], (*t.control, t.naming))
        return F.array(
            segment(F.concat(F.lit(t.opening), name, F.lit(t.naming)), False),
            segment(escaped(x["text"], t.control), x["role"].isin(*t.learned)),
            segment(t.closing, False),
        )

    out = turns.select(
        conv,
        F.flatten(F.transform("turns", written)).alias("segments"),
        F.coalesce(_walk(F.col("turns"), t).isin(*t.final), F.lit(False)).alias("valid"),
    )
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(df: DataFrame, template: Template = Template(), column: str = "formatted") -> DataFrame:
    """Add ``turns``, an array of (role, text), parsed from a formatted conversation."""
    t = template
    pieces = F.split(F.col(column), re.escape(t.closing))

    def parsed(piece: Column) -> Column:
        body = F.substr(piece, F.lit(len(t.opening) + 1))
        at = F.instr(body, t.naming)
        return F.struct(
            unescaped(F.substr(body, F.lit(1), at - 1)).alias("role"),
            unescaped(F.substr(body, at + len(t.naming))).alias("text"),
        )

    # What follows the last closing mark is empty.
    return df.withColumn("turns", F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), parsed))


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
