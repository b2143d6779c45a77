"""Chat formatting with built-in functions only.

A declarative template names the marks around a turn, the roles that carry loss and the
allowed moves between roles. A state machine folds over the roles of a conversation and
names the first turn out of order; the formatted text comes as segments with a loss flag
each, whose texts joined are the formatted conversation. Control strings and the escape
character inside texts become the escape character and a digit or letter, so a text
never holds a mark, and reading back is exact.

Defined results: turns are ordered by turn, role and text (null turns first), repeated
rows are turns of their own; a null text or role is an empty one; roles that the template
doesn't name stand in the general mark and are out of order; rows without conv_id form
one conversation without id; an empty table gives an empty table; further columns are
left out. A conversation out of order is formatted all the same and flagged.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.shared import table

START, END = "start", "end"


@dataclass(frozen=True)
class Template:
    """``marks`` open the turns of named roles; other roles stand between ``other_open``
    and ``other_close``. ``moves`` maps a role to those that may follow it."""

    marks: dict[str, str] = field(
        default_factory=lambda: {
            "system": "### System: ",
            "user": "### User: ",
            "assistant": "### Assistant: ",
        }
    )
    other_open: str = "### Role <"
    other_close: str = ">: "
    close: str = "</turn>\n"
    loss: tuple[str, ...] = ("assistant",)
    moves: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            START: ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user", END),
        }
    )
    escape: str = "\\"

    def codes(self) -> list[tuple[str, str]]:
        """Strings to escape and their codes, the escape character first."""
        plain = [self.close, self.close.strip(), self.other_open, self.other_close]
        plain += [m for mark in self.marks.values() for m in (mark, mark.strip())]
        # Longer strings first, so that none is cut by a shorter one inside it.
        control = sorted({s for s in plain if s}, key=lambda s: (-len(s), s))
        digits = "123456789abcdefghijklmnopqrstuvwxyz"
        if len(control) > len(digits) or any(self.escape in s or s[0] in "0" + digits for s in control):
            raise ValueError("too many control strings, or one holds the escape character or starts like a code")
        return [(self.escape, self.escape + "0")] + [
            (s, self.escape + digits[i]) for i, s in enumerate(control)
        ]

    def escaped(self, text: Column) -> Column:
        return reduce(lambda t, c: F.replace(t, F.lit(c[0]), F.lit(c[1])), self.codes(), text)

    def unescaped(self, text: Column) -> Column:
        """Each escape character starts a code of two, so codes can't overlap."""
        return reduce(lambda t, c: F.replace(t, F.lit(c[1]), F.lit(c[0])), reversed(self.codes()), text)

    def mark(self, role: Column) -> Column:
        general = F.concat(F.lit(self.other_open), self.escaped(role), F.lit(self.other_close))
        named = F.coalesce(*[F.when(role == r, F.lit(m)) for r, m in self.marks.items()])
        return F.coalesce(named, general)


def first_error(roles: Column, template: Template) -> Column:
    """Index (from 0) of the first turn that the state machine refuses, the number of
    turns if the conversation may not end there, null if all is in order."""

    def allowed(state: Column, role: Column) -> Column:
        moves = [(state == s) & role.isin(*after) for s, after in template.moves.items()]
        return reduce(lambda a, b: a | b, moves)

    def step(s: Column, role: Column) -> Column:
        bad = F.when(s["bad"].isNull() & ~allowed(s["state"], role), s["n"]).otherwise(s["bad"])
        return F.struct(role.alias("state"), (s["n"] + 1).alias("n"), bad.alias("bad"))

    begin = F.struct(
        F.lit(START).alias("state"), F.lit(0).alias("n"), F.lit(None).cast("int").alias("bad")
    )
    done = F.aggregate(roles, begin, step)
    return F.coalesce(done["bad"], F.when(~allowed(done["state"], F.lit(END)), done["n"]))


def conversations(turns: DataFrame) -> DataFrame:
    """Rows ``(conv_id, turns)``, the turns of a conversation in order."""
    one = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("turns"))


def chat_format(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """Rows ``(conv_id, formatted, segments, valid, error_turn)``; ``segments`` are
    structs ``(text, loss)``."""
    template = template or Template()

    def segments(t: Column) -> Column:
        flag = t["role"].isin(*template.loss)
        parts = [(template.mark(t["role"]), F.lit(False)), (template.escaped(t["text"]), flag)]
        parts.append((F.lit(template.close), F.lit(False)))
        return F.array(*[F.struct(text.alias("text"), loss.alias("loss")) for text, loss in parts])

    error = first_error(F.col("turns.role"), template)
    return (
        conversations(turns)
        .select(
            "conv_id",
            F.flatten(F.transform("turns", segments)).alias("segments"),
            error.alias("error_turn"),
        )
        .select(
            "conv_id",
            F.array_join("segments.text", "").alias("formatted"),
            "segments",
            F.isnull("error_turn").alias("valid"),
            "error_turn",
        )
    )


def read_back(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """The turns as structs ``(role, text)`` read from ``formatted``, and the text under
    the loss flags read from ``segments``, both with the escapes undone."""
    template = template or Template()

    def turn(body: Column) -> Column:
        text, role = F.lit(None).cast("string"), F.lit(None).cast("string")
        for name, mark in template.marks.items():
            here = F.startswith(body, F.lit(mark))
            role = F.when(here, F.lit(name)).otherwise(role)
            text = F.when(here, F.substr(body, F.lit(len(mark) + 1))).otherwise(text)
        rest = F.substr(body, F.lit(len(template.other_open) + 1))
        until = F.instr(rest, template.other_close)
        other = template.unescaped(F.substr(rest, F.lit(1), until - 1))
        other_text = F.substr(rest, until + len(template.other_close))
        return F.struct(
            F.coalesce(role, other).alias("role"),
            template.unescaped(F.coalesce(text, other_text)).alias("text"),
        )

    bodies = F.split("formatted", F.lit("\\Q" + template.close + "\\E"))
    bodies = F.slice(bodies, 1, F.size(bodies) - 1)  # nothing stands after the last mark
    lossy = F.filter("segments", lambda s: s["loss"])
    return formatted.select(
        "conv_id",
        F.transform(bodies, turn).alias("turns"),
        F.array_join(F.transform(lossy, lambda s: template.unescaped(s["text"])), "").alias("loss_text"),
        "formatted",
        "valid",
    )


PROBE = r"\### Assistant: </turn> ok"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    back = read_back(chat_format(own.unionByName(probe)))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def sql(template: Template | None = None) -> str:
    """The twin formats in SQL too, for the length; the rest comes from the rows."""
    template = template or Template()
    quoted = lambda s: "'" + s.replace("'", "''") + "'"

    def escaped(text: str) -> str:
        return reduce(lambda t, c: f"replace({t}, {quoted(c[0])}, {quoted(c[1])})", template.codes(), text)

    marks = " ".join(f"WHEN role = {quoted(r)} THEN {quoted(m)}" for r, m in template.marks.items())
    general = f"{quoted(template.other_open)} || {escaped('role')} || {quoted(template.other_close)}"
    moves = " OR ".join(
        f"(state = {quoted(s)} AND role IN ({', '.join(map(quoted, after))}))" for s, after in template.moves.items()
    )
    probe = quoted(PROBE)
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', {probe} UNION ALL SELECT -7, 1, 'assistant', {probe}),
made AS (
  SELECT *, lag(role, 1, {quoted(START)}) OVER w AS state, lead(role) OVER w IS NULL AS ends,
    CASE {marks} ELSE {general} END || {escaped('text')} || {quoted(template.close)} AS body
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
steps AS (
  SELECT *, ({moves}) AS fits FROM made),
last AS (
  SELECT conv_id, ({moves}) AS ends_well
  FROM (SELECT conv_id, role AS state, {quoted(END)} AS role FROM made WHERE ends))
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role IN ({', '.join(map(quoted, template.loss))})), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
    FILTER (role IN ({', '.join(map(quoted, template.loss))})), '')) AS loss_sha256,
  CAST(sum(length(body)) AS BIGINT) AS formatted_chars, bool_and(fits) AND any_value(ends_well) AS valid
FROM steps JOIN last USING (conv_id) GROUP BY conv_id
"""
