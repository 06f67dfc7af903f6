r"""Chat formatting with a grammar that is parsed back.

    conversation := turn*
    turn         := "### " role ": " text "\n</turn>\n"

A control string ("### " or "</turn>") behind a backslash is text.  Each turn
is rendered as it is, parsed by the grammar and compared with its source; only
if that differs are the control strings of its text escaped, by one backslash
more before each, and the result is parsed again.  Whole conversations are
parsed and compared once more.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "### ", "</turn>"
_CONTROL = f"({START}|{END})"
_TURN = r"(?s)\A### ((?:[^\\:]++|\\.)*+): (.*)\n\z"


def escape_text(text: Column) -> Column:
    """One more backslash before each control string."""
    return F.regexp_replace(text, _CONTROL, r"\\$1")


def unescape_text(text: Column) -> Column:
    """One backslash less before each control string behind one."""
    return F.regexp_replace(text, r"\\" + _CONTROL, "$1")


def _head(role: Column) -> Column:
    return F.concat(F.lit(START), F.regexp_replace(role, r"([\\:<])", r"\\$1"), F.lit(": "))


def _render(role: Column, text: Column) -> Column:
    return F.concat(_head(role), text, F.lit(f"\n{END}\n"))


def parse_turns(formatted: Column) -> Column:
    """Turns (role, text) of a formatted text; fields are null where it breaks the grammar."""
    parts = F.split(formatted, r"(?<!\\)" + END + r"\n?")

    def turn(seg: Column) -> Column:
        body = F.regexp_extract(seg, _TURN, 2)
        good = seg.rlike(_TURN) & ~body.rlike(r"(?<!\\)" + START)
        role = F.regexp_replace(F.regexp_extract(seg, _TURN, 1), r"(?s)\\(.)", "$1")
        return F.struct(F.when(good, role).alias("role"), F.when(good, unescape_text(body)).alias("text"))
    # The text behind the last end mark must be empty; if not, it is a broken turn.
    whole = F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    return F.transform(whole, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    piece = F.transform(spans, lambda s: unescape_text(F.substring(formatted, s["start"] + 1, s["end"] - s["start"])))
    return F.array_join(piece, "")


def format_chats(conversations: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss_spans (start and end code points in ``formatted``
    of the texts of ``loss_role``).

    * Null texts and null roles are empty.
    * Turns are ordered by turn (null first), then role, then text; repeated
      rows are turns of their own.
    * The null conv_id is one conversation; an empty table gives none.
    * A formatted conversation is one value, so its turns meet in one task.
    * Extra columns are ignored.  A text that cannot be recovered is an error.
    """
    c = conversations.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    plain = _render(F.col("role"), F.col("text"))
    same = parse_turns(plain) == F.array(F.struct("role", "text"))
    c = c.withColumn("out", F.when(F.coalesce(same, F.lit(False)), plain)
                     .otherwise(_render(F.col("role"), escape_text(F.col("text")))))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.coalesce(F.sum(F.char_length("out")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = before + F.char_length(_head(F.col("role")))
    end = before + F.char_length("out") - len(f"\n{END}\n")
    c = c.withColumn("at", F.row_number().over(order)) \
        .withColumn("span", F.when(F.col("role") == loss_role, F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"))))
    turns = F.array_sort(F.collect_list(F.struct("at", "role", "text", "out", "span")))
    g = c.groupBy("conv_id").agg(turns.alias("turns"))
    g = g.withColumn("formatted", F.array_join(F.transform("turns", lambda t: t["out"]), ""))
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    spans = F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull())
    checked = F.when(F.coalesce(parse_turns(F.col("formatted")) == source, F.lit(False)), F.col("formatted")) \
        .otherwise(F.raise_error(F.concat(F.lit("conversation cannot be recovered: "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))))
    return g.select("conv_id", checked.alias("formatted"), spans.alias("loss_spans"))


def read_back(chats: DataFrame) -> DataFrame:
    """Digests of the turns and of the loss text, parsed from the formatted texts."""
    turns = F.transform(parse_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    c = chats.select("conv_id", "formatted", turns.alias("turns"), loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return c.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
                    F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                    F.char_length("formatted").cast("long").alias("formatted_chars"))
