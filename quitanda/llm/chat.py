"""Operator 3: chat formatting with a grammar round trip, in DataFrame functions only.

Grammar of a formatted conversation::

    conversation := turn*
    turn         := "<s>[INST] " role " [/INST]" text "</s>"

``parse`` reads it back deterministically: a turn ends at the first ``</s>``, a
role at the first `` [/INST]``, then escapes are undone.  A turn is rendered as it
is, parsed and compared with its source; where they differ, or where a control
string stands inside role or text, its conflicting content is escaped: ``\\``
becomes ``\\e`` and the first character of a control string ``\\l`` (for ``<``) or
``\\b`` (for ``[``).  So no control string ever stands inside a text, and what
needs no escape is left as it is.  ``round_trip`` tells that the whole
conversation, parsed again, equals its source.

The loss mask is the list of (start, end) code points of the assistants' texts
in the formatted string.

Defined cases: null role and null text are empty; turns are ordered by turn
(null first), role and text, so that repeated turns have one order; rows with a
null conv_id are one conversation; repeated rows are turns of their own; an
empty table gives no rows; very long texts are rendered whole; only the four named
columns are read, so others can have any name.  A conversation is one output
string, so its turns meet in one row; nothing wider than a conversation does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The control strings of the template.
BEGIN, END, OPEN, CLOSE = "<s>", "</s>", "[INST]", "[/INST]"
CONTROL = (BEGIN, END, OPEN, CLOSE)
ASSISTANT = "assistant"
#: Pattern of a rendered turn without its end.
TURN = r"(?s)^<s>\[INST\] (.*?) \[/INST\](.*)$"


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(f"{BEGIN}{OPEN} "), role, F.lit(f" {CLOSE}"), text, F.lit(END))


def escape(text: Column) -> Column:
    """Reversible form without any control string."""
    out = F.replace(text, F.lit("\\"), F.lit("\\e"))
    for control in CONTROL:
        code = "\\l" if control[0] == "<" else "\\b"
        out = F.replace(out, F.lit(control), F.lit(code + control[1:]))
    return out


def unescape(text: Column) -> Column:
    """Undo ``escape``; each code is a backslash and one letter, so none arises from others."""
    for code, char in (("\\l", "<"), ("\\b", "["), ("\\e", "\\")):
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def pieces(formatted: Column) -> Column:
    """The turns of a formatted string, each without its end, as array<string>."""
    split = F.split(formatted, END, -1)
    return F.slice(split, 1, F.size(split) - 1)


def parse(formatted: Column) -> Column:
    """Turns of a formatted string as array<struct<role, text>>."""
    return F.transform(pieces(formatted), lambda p: F.struct(
        unescape(F.regexp_extract(p, TURN, 1)).alias("role"), unescape(F.regexp_extract(p, TURN, 2)).alias("text")))


def _holds_control(text: Column) -> Column:
    found = F.lit(False)
    for control in CONTROL:
        found = found | F.contains(text, F.lit(control))
    return found


def _survives(role: Column, text: Column) -> Column:
    """Whether the turn, rendered as it is, is read back as it was and holds no control string."""
    back = parse(render(role, text))
    return (~_holds_control(role) & ~_holds_control(text) & (F.size(back) == 1)
            & (F.get(back, F.lit(0))["role"] == role) & (F.get(back, F.lit(0))["text"] == text))


def format_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans array<struct<start, end>>, n_escaped, round_trip."""
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("plain", _survives(F.col("role"), F.col("text")))
    rows = rows.withColumns({
        "shown_role": F.when(F.col("plain"), F.col("role")).otherwise(escape(F.col("role"))),
        "shown": F.when(F.col("plain"), F.col("text")).otherwise(escape(F.col("text")))})
    rows = rows.withColumn("rendered", render(F.col("shown_role"), F.col("shown")))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("place", F.row_number().over(order)).withColumn(
        "until", F.sum(F.length("rendered").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    end = F.col("until") - F.lit(len(END))
    span = F.struct((end - F.length("shown")).alias("start"), end.alias("end"))
    rows = rows.select("conv_id", "plain", F.struct(
        "place", "rendered", F.when(F.col("role") == ASSISTANT, span).alias("span"),
        F.struct("role", "text").alias("source")).alias("turn"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"),
                                        F.sum((~F.col("plain")).cast("long")).alias("n_escaped"))
    whole = whole.withColumn("formatted", F.concat_ws("", F.col("turns.rendered")))
    return whole.select("conv_id", "formatted", F.array_compact(F.col("turns.span")).alias("loss_spans"), "n_escaped",
                        (parse(F.col("formatted")) == F.col("turns.source")).alias("round_trip"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Contract columns, from the formatted strings and their loss masks alone."""
    turns = F.transform("parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    masked = F.transform("loss_spans", lambda s: F.substring(
        F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    out = formatted.withColumn("parsed", parse(F.col("formatted"))).withColumn(
        "loss", F.concat_ws("", F.transform(masked, unescape)))
    return out.select(
        "conv_id", F.size("parsed").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", turns).cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "n_escaped", "round_trip")


#: Contract columns in SQL; a turn is escaped if it holds a control string or what would be undone as an escape.
ORACLE = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), flagged AS (
  SELECT *, regexp_matches(role || chr(0) || text, '<s>|</s>|\\[INST\\]|\\[/INST\\]|\\\\[lbe]') AS odd FROM rows
), shown AS (
  SELECT *, length(role) + length(text) + CASE WHEN odd THEN
      length(regexp_replace(role || text, '[^\\\\]', '', 'g'))
      + len(regexp_extract_all(role, '<s>|</s>|\\[INST\\]|\\[/INST\\]'))
      + len(regexp_extract_all(text, '<s>|</s>|\\[INST\\]|\\[/INST\\]')) ELSE 0 END AS chars FROM flagged
), convs AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(chars + 22) AS formatted_chars, count(*) FILTER (odd) AS n_escaped
  FROM shown GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(formatted_chars AS BIGINT) AS formatted_chars, n_escaped, true AS round_trip FROM convs
"""
