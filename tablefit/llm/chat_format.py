"""Chat formatting with a grammar round trip.

Template: a turn is ``<|im_start|>`` role newline text ``<|im_end|>`` newline; a conversation is its turns in order.

Parser (deterministic): cut at ``<|im_end|>`` newline; each piece starts with the start mark; the role goes to the first
newline, the text follows; texts are unescaped by taking one backslash out of every ``<``, backslashes, ``|``
sequence that has one, roles by reading their backslash codes.

A turn is first rendered as it is and parsed again.  Where that does not give back the same turn, or the text holds the
beginning of a control string, its content is escaped (one backslash put into every ``<``, backslashes, ``|``) and
checked again; a turn that still differs fails the job.  A rendered turn holds exactly one end mark, at
its end, so turns that round-trip alone round-trip in any sequence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablefit.llm.common import quoted

START = "<|im_start|>"
END = "<|im_end|>\n"
END_PATTERN = r"<\|im_end\|>\n"
CONTROL = r"<\\*\|"


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("\\"), F.lit("\\e")), F.lit("\n"), F.lit("\\n")), F.lit("|"), F.lit("\\p"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("\\p"), F.lit("|")), F.lit("\\n"), F.lit("\n")), F.lit("\\e"), F.lit("\\"))


def render(role: Column, content: Column) -> Column:
    return F.concat(F.lit(START), escape_role(role), F.lit("\n"), content, F.lit(END))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of (role, text)."""
    pieces = F.split(formatted, END_PATTERN, -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)  # behind the last end mark is nothing

    def turn(piece: Column) -> Column:
        body = F.substring(piece, len(START) + 1, F.length(piece))
        role = F.substring_index(body, "\n", 1)
        return F.struct(unescape_role(role).alias("role"),
                        unescape_text(F.substring(body, F.length(role) + 2, F.length(body))).alias("text"))

    return F.transform(pieces, turn)


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row for each conversation: its id, ``formatted``, ``n_turns`` and ``loss_spans``.

    Turns go by the turn column (null first), ties by role, then text; repeated rows are repeated turns.  Null roles and
    texts are empty; rows with a null id form one conversation of their own.  ``loss_spans`` holds the
    [start, end) of each text of ``loss_role`` in ``formatted``, in code points.  Other columns are ignored, whatever their names; an
    empty table gives no rows.  A conversation is the unit of the result: its turns meet in one row, texts of any length whole.
    """
    given = turns.select(quoted(conv_col).alias("conv"), quoted(turn_col).alias("turn"),
                         F.coalesce(quoted(role_col).cast("string"), F.lit("")).alias("role"),
                         F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text"))

    def same(rendered: Column) -> Column:
        return parse(rendered) == F.array(F.struct(F.col("role"), F.col("text")))

    plain = given.withColumn("rendered", render(F.col("role"), F.col("text")))
    plain = plain.withColumn("conflict", F.col("text").rlike(CONTROL) | ~same(F.col("rendered")))
    content = F.when(F.col("conflict"), escape_text(F.col("text"))).otherwise(F.col("text"))
    checked = (
        plain.withColumn("content", content)
        .withColumn("rendered", F.when(F.col("conflict"), render(F.col("role"), F.col("content"))).otherwise(F.col("rendered")))
        .withColumn("rendered", F.when(~F.col("conflict") | same(F.col("rendered")), F.col("rendered")).otherwise(F.raise_error(F.lit("a turn does not survive the round trip"))))
        .withColumn("chars", F.length("rendered"))
    )
    order = Window.partitionBy("conv").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = checked.withColumn("until", F.sum("chars").over(order)).select("conv", "until", "role", "rendered", F.length("content").alias("content_chars"))
    return (
        placed.groupBy("conv")
        .agg(F.sort_array(F.collect_list(F.struct("until", "role", "rendered", "content_chars"))).alias("turns"))
        .select(
            F.col("conv").alias(conv_col),
            F.array_join(F.col("turns.rendered"), "").alias("formatted"),
            F.size("turns").cast("long").alias("n_turns"),
            F.transform(
                F.filter("turns", lambda t: t["role"] == loss_role),
                lambda t: F.struct((t["until"] - len(END) - t["content_chars"]).alias("start"), (t["until"] - len(END)).alias("end")),
            ).alias("loss_spans"),
        )
    )
