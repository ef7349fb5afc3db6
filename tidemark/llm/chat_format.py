"""Chat formatting on DataFrame functions alone: a finite-state machine over roles and segments with loss flags.

A template declares the marks of a turn, the roles whose text is trained on and the moves of the machine. Rows
are sorted by range, so that a long conversation lies over several tasks, and cut into chunks of neighbours. A
chunk runs the machine from every state at once; the runs of a conversation's chunks are then put together
from its first one, so no task walks the rows of a whole conversation. Each turn gives three
segments (what opens it, its text, what closes it), of which only texts of trained roles count for the loss.

Inside texts and roles every ``<|`` gets a backslash more between its two characters, which is taken away again
when they are read; a mark of the template thus never occurs inside a text.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import col, stored

#: Rows of a chunk, as a power of two.
CHUNK_BITS = 8


@dataclass(frozen=True)
class Template:
    """``opening`` role ``role_end`` text ``closing``, for each turn; both marks begin with ``<|``.

    ``moves`` gives the next state for (state, role), beginning at ``start``; a role for which a state has no
    move breaks the order. The defaults are the marks and the order of ChatML.
    """

    opening: str = "<|im_start|>"
    role_end: str = "\n"
    closing: str = "<|im_end|>\n"
    trained: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: Mapping[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "asked",
            ("start", "user"): "said",
            ("asked", "user"): "said",
            ("said", "assistant"): "answered",
            ("answered", "user"): "said",
        }
    )

    def __post_init__(self) -> None:
        if not (self.opening.startswith("<|") and self.closing.startswith("<|") and self.role_end == "\n"):
            raise ValueError("marks must begin with <| and a role must end with a line end")

    @property
    def states(self) -> list[str]:
        """The start first, the broken state last."""
        named = dict.fromkeys([self.start, *(s for (s, _), _ in self.moves.items()), *self.moves.values()])
        return [*named, "broken"]

    @property
    def roles(self) -> list[str]:
        return list(dict.fromkeys(role for _, role in self.moves))

    def table(self) -> list[list[int]]:
        """table[state][place of the role, 0 for roles without any move]: the place of the next state."""
        states = self.states
        broken = len(states) - 1
        after = [[states.index(self.moves[s, r]) if (s, r) in self.moves else broken for r in self.roles] for s in states]
        return [[broken, *row] for row in after]


CHATML = Template()


def escaped(text: Column) -> Column:
    """Each ``<``, backslashes, ``|`` with one backslash more."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def _escaped_role(role: Column) -> Column:
    """As escaped, and on one line."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescaped_role(role: Column) -> Column:
    lines = F.regexp_replace(unescaped(role), r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return F.replace(lines, F.lit("\\\\"), F.lit("\\"))


def _machine(template: Template, state: Column, steps: Column) -> Column:
    """(state, broke) after the role places ``steps``, from ``state``: broke is the first turn that broke the order, or 0."""
    table = F.lit(template.table())
    broken = F.lit(len(template.states) - 1)

    def step(acc: Column, role: Column) -> Column:
        after = F.get(F.get(table, acc["state"]), role)
        broke = F.when((acc["broke"] == 0) & (after == broken), acc["seen"] + 1).otherwise(acc["broke"])
        return F.struct(after.alias("state"), (acc["seen"] + 1).alias("seen"), broke.alias("broke"))

    zero = F.lit(0).cast("long")
    first = F.struct(state.alias("state"), zero.alias("seen"), zero.alias("broke"))
    return F.aggregate(steps, first, step)


def _segments(template: Template, turn: Column) -> Column:
    trained = F.coalesce(turn["role"].isin(*template.trained), F.lit(False))
    opening = F.concat(F.lit(template.opening), _escaped_role(turn["role"]), F.lit(template.role_end))
    return F.array(
        F.struct(opening.alias("text"), F.lit(False).alias("loss")),
        F.struct(escaped(turn["text"]).alias("text"), trained.alias("loss")),
        F.struct(F.lit(template.closing).alias("text"), F.lit(False).alias("loss")),
    )


def placed_turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """A written table (conv, place, role, text), places rising with conversation and turn.

    Sorted by range over all rows: a conversation or turn of very many rows takes several tasks. Equal turns are
    put by role and digest of their text.
    """
    rows = conversations.select(
        col(conv_col).alias("conv"),
        col(turn_col).alias("turn"),
        F.coalesce(col(role_col), F.lit("")).alias("role"),
        F.coalesce(col(text_col), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("salt"),
    )
    order = ["conv", "turn", "role", "digest", "salt"]
    rows = rows.withColumn("digest", F.sha2("text", 256)).repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(rows.select("conv", F.monotonically_increasing_id().alias("place"), "role", "text"), "turns")


def format_conversations(
    conversations: DataFrame,
    template: Template = CHATML,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv_id, n_turns, segments array<struct<text, loss>>, valid, broke_at) of every conversation.

    The formatted text is that of the segments one after another. ``valid`` tells whether the machine took
    every turn, ``broke_at`` the first turn, from 1, that it had no move for (null where valid); conversations
    that break the order are formatted all the same, whole, and it is for the caller to leave them out.
    Turns are put in the order of ``turn``, null first, equal ones by role and digest of their text, and rows
    that repeat are turns of their own. Null roles and texts count as empty; an empty role has no
    move. Rows without a conversation are one conversation with a null id. A conversation is one row of the
    result, as a document is. Other columns are ignored, and an empty table gives an empty result.
    """
    turns = placed_turns(conversations, conv_col, turn_col, role_col, text_col)
    states = len(template.states)
    role_place = lambda t: F.array_position(F.lit(template.roles), t["role"]).cast("int")
    chunk = F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("turns")
    chunks = turns.groupBy("conv", F.shiftright("place", CHUNK_BITS).alias("chunk")).agg(chunk)
    steps = F.transform("turns", role_place)
    chunks = chunks.select(
        "conv",
        "chunk",
        F.size("turns").cast("long").alias("n"),
        F.array(*(_machine(template, F.lit(s), steps) for s in range(states))).alias("runs"),
        F.flatten(F.transform("turns", lambda t: _segments(template, t))).alias("segments"),
    )
    whole = chunks.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("chunk", "n", "runs", "segments"))).alias("chunks"))

    def joined(acc: Column, part: Column) -> Column:
        run = F.get(part["runs"], acc["state"])
        broke = F.when((acc["broke"] == 0) & (run["broke"] > 0), acc["seen"] + run["broke"]).otherwise(acc["broke"])
        return F.struct(run["state"].alias("state"), (acc["seen"] + part["n"]).alias("seen"), broke.alias("broke"))

    zero = F.lit(0).cast("long")
    end = F.aggregate("chunks", F.struct(F.lit(0).alias("state"), zero.alias("seen"), zero.alias("broke")), joined)
    return whole.select(
        F.col("conv").alias("conv_id"),
        end.alias("end"),
        F.flatten(F.col("chunks.segments")).alias("segments"),
    ).select(
        "conv_id",
        F.col("end.seen").alias("n_turns"),
        "segments",
        (F.col("end.state") < states - 1).alias("valid"),
        F.nullif(F.col("end.broke"), zero).alias("broke_at"),
    )


def parsed_turns(formatted: Column, template: Template = CHATML) -> Column:
    """array<struct<role, text>> of a formatted text: format_conversations undone."""
    opening = "".join(f"\\{c}" if not c.isalnum() and c != "_" else c for c in template.opening)
    parts = F.filter(F.split(formatted, opening, -1), lambda part, i: i > 0)

    def turn(part: Column) -> Column:
        role = F.substring_index(part, template.role_end, 1)
        text = F.substr(part, F.length(role) + 2, F.length(part) - F.length(role) - 1 - len(template.closing))
        return F.struct(_unescaped_role(role).alias("role"), unescaped(text).alias("text"))

    return F.transform(parts, turn)


def conversation_digests(formatted: DataFrame, template: Template = CHATML) -> DataFrame:
    """The written segments read back: turns by parsing the formatted text, trained text by the loss flags.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid, broke_at).
    """
    whole = formatted.select(
        "conv_id",
        F.array_join("segments.text", "").alias("formatted"),
        F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"])), "").alias("loss"),
        "valid",
        "broke_at",
    )
    turns = whole.withColumn("turns", parsed_turns(F.col("formatted"), template))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        "broke_at",
    )


def formatted_conversations(conversations: DataFrame, template: Template = CHATML) -> DataFrame:
    """Writes format_conversations to the shared folder and gives what is read back from it (conversation_digests)."""
    return conversation_digests(stored(format_conversations(conversations, template), "chat"), template)
