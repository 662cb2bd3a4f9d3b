"""Chat formatting: a state machine checks the turns, a template writes them with loss flags."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Mark:
    """What stands before and after the text of a role, and whether its text is learned."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks by role, the marks of any other role, and the order in which turns may come.

    Every control string begins with a character of `opens`, and its next character is not the
    escape. In texts each of these characters, and the escape itself, is followed by the escape,
    so that no control string can occur there.
    """

    marks: dict[str, Mark]
    other: Mark
    named: str
    opens: str
    escape: str
    start: str
    moves: dict[tuple[str, str], str]
    final: tuple[str, ...]


# Control strings as instruction-tuned models use them.
INSTRUCT = Template(
    marks={"system": Mark("<<SYS>>", "<</SYS>>"), "user": Mark("[INST]", "[/INST]"),
           "assistant": Mark("<s>", "</s>", loss=True)},
    other=Mark("[ROLE:", "[/ROLE]"), named="[:]", opens="<[", escape="\\", start="begin",
    moves={("begin", "system"): "instructed", ("begin", "user"): "asked", ("instructed", "user"): "asked",
           ("asked", "assistant"): "answered", ("answered", "user"): "asked"},
    final=("answered",))


def _special(template: Template) -> str:
    return "([" + "".join("\\" + c for c in template.opens + template.escape) + "])"


def escaped(text: Column, template: Template) -> Column:
    return F.regexp_replace(text, F.lit(_special(template)), F.lit("$1\\" + template.escape))


def unescaped(text: Column, template: Template) -> Column:
    return F.regexp_replace(text, F.lit(f"{_special(template)}\\{template.escape}"), F.lit("$1"))


def final_state(roles: Column, template: Template) -> Column:
    """The state after all roles; "invalid" for good once a turn is out of order."""
    moves = F.create_map(*[F.lit(x) for (state, role), to in template.moves.items() for x in (f"{state}|{role}", to)])
    return F.aggregate(roles, F.lit(template.start), lambda state, role: F.coalesce(
        F.try_element_at(moves, F.concat(state, F.lit("|"), role)), F.lit("invalid")))


def _segments(turn: Column, template: Template) -> Column:
    """Three segments per turn: mark, text, mark. A role that the template lacks is kept by name."""
    def of(before: Column, mark: Mark) -> Column:
        text = escaped(turn["text"], template)
        return F.array(F.struct(before.alias("text"), F.lit(False).alias("loss")),
                       F.struct(text.alias("text"), F.lit(mark.loss).alias("loss")),
                       F.struct(F.lit(mark.after).alias("text"), F.lit(False).alias("loss")))

    head = F.concat(F.lit(template.other.before), escaped(turn["role"], template), F.lit(template.named))
    result = of(head, template.other)
    for role, mark in template.marks.items():
        result = F.when(turn["role"] == role, of(F.lit(mark.before), mark)).otherwise(result)
    return result


def format_conversations(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per conversation from rows (conv_id, turn, role, text).

    Returns conv_id, segments (text, loss; the formatted text is all of them in order), state of
    the turn order's machine, and valid. Conversations of a wrong order are formatted too and
    marked invalid. Rows go by turn, those of one turn by role and text, nulls first; a null text
    or role counts as empty; repeated rows are repeated turns; other columns are ignored; no rows
    give no rows.
    """
    empty = F.lit("")
    turn = F.struct("turn", F.coalesce(F.col("role").cast("string"), empty).alias("role"),
                    F.coalesce(F.col("text").cast("string"), empty).alias("text"))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    state = final_state(F.transform("turns", lambda t: t["role"]), template)
    return grouped.select(
        "conv_id", F.flatten(F.transform("turns", lambda t: _segments(t, template))).alias("segments"),
        state.alias("state"), state.isin(*template.final).alias("valid"))


def _turn_pattern(template: Template) -> str:
    """One formatted turn: its opening mark, its escaped text, its closing mark."""
    before = [re.escape(m.before) for m in template.marks.values()]
    before.append(f"{re.escape(template.other.before)}.*?{re.escape(template.named)}")
    after = [re.escape(m.after) for m in (*template.marks.values(), template.other)]
    return f"(?s)({'|'.join(before)})(.*?)({'|'.join(after)})"


def parse_conversations(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Turns and learned text out of formatted segments.

    The turns (role, text) are found in the joined text alone, by the template's marks; `learned`
    is the unescaped text of the segments under the loss mask.
    """
    rows = formatted.select("*", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))
    pattern = F.lit(_turn_pattern(template))
    heads = F.regexp_extract_all("formatted", pattern, F.lit(1))
    texts = F.regexp_extract_all("formatted", pattern, F.lit(2))

    def role(head: Column) -> Column:
        before, named = len(template.other.before), len(template.named)
        result = unescaped(head.substr(F.lit(before + 1), F.length(head) - before - named), template)
        for known, mark in template.marks.items():
            result = F.when(head == mark.before, F.lit(known)).otherwise(result)
        return result

    turns = F.transform(F.arrays_zip(heads.alias("head"), texts.alias("text")),
                        lambda t: F.struct(role(t["head"]).alias("role"), unescaped(t["text"], template).alias("text")))
    learned = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"], template))
    return rows.select("conv_id", turns.alias("turns"), F.array_join(learned, "").alias("learned"), "formatted",
                       "state", "valid")


def turn_digest(parsed: DataFrame) -> DataFrame:
    """The contract's columns from what was read back."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return parsed.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"), F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"), "valid")
