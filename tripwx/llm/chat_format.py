"""Chat formatting with a grammar round trip.

A conversation is rendered as turns ``[INST]role[/INST]text</s>``.  The
parser is deterministic: cut at every ``</s>``, then at the first
``[/INST]``, drop the leading ``[INST]``, take one escape out of every
escaped control string.  A control string is escaped by a backslash after
its first character (``<\\/s>``); one that already holds backslashes gets
one more, so escaping is reversible.  Content is escaped only where it is
needed: each turn is rendered, reparsed and compared, and what does not come
back identical is escaped.  The whole conversation is then reparsed and
compared with its source, and an error if it differs.

The loss mask covers the text of assistant turns: ``loss_spans`` holds its
code-point spans in the formatted text.

Only DataFrame functions are used.  Turns shuffle once, by conversation; a
conversation is one row of the result, so its turns meet in one task.

Defined results: turns stand by number, nulls first, ties by role and then
text; repeated rows are repeated turns; a null text or role is an empty one;
a null id is a conversation of its own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, MID, CLOSE = "[INST]", "[/INST]", "</s>"
HEADS, TAILS = r"[\[<]", r"INST\]|/INST\]|/s>"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, rf"({HEADS})(\\*)({TAILS})", r"$1\\$2$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, rf"({HEADS})\\(\\*)({TAILS})", "$1$2$3")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(MID), text, F.lit(CLOSE))


def _turn(piece: Column) -> Column:
    mid = F.instr(piece, MID) if isinstance(piece, str) else F.locate(MID, piece)
    role = F.substr(piece, F.lit(len(OPEN) + 1), mid - len(OPEN) - 1)
    text = F.substr(piece, mid + len(MID))
    good = piece.startswith(OPEN) & (mid > 0)
    return F.when(good, F.struct(unescape(role).alias("role"), unescape(text).alias("text")))


def parse(formatted: Column) -> Column:
    """array<struct<role,text>>; a piece outside the grammar is a null turn."""
    return F.transform(F.filter(F.split(formatted, CLOSE, -1), lambda x: x != ""), _turn)


def _round_trip(role: Column, text: Column, raw_role: Column, raw_text: Column) -> Column:
    back = parse(render(role, text))
    return F.coalesce((F.size(back) == 1) & (back[0]["role"] == raw_role) & (back[0]["text"] == raw_text), F.lit(False))


def fit_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and the forms ``_role`` and ``_text`` that
    survive the round trip."""
    df = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                              F.coalesce("text", F.lit("")).alias("text"))
    same = _round_trip(F.col("role"), F.col("text"), F.col("role"), F.col("text"))
    return df.withColumn("_same", same).withColumns(
        {f"_{c}": F.when(F.col("_same"), F.col(c)).otherwise(escape(F.col(c))) for c in ("role", "text")}).drop("_same")


def format_conversations(conversations: DataFrame, strict: bool = True) -> DataFrame:
    """conv_id, formatted, loss_spans array<struct<start,end>> (code points,
    end exclusive) and same: the whole output, parsed, is the source.  A
    conversation that does not come back identical is an error, or, if not
    ``strict``, a row whose ``same`` is false."""
    df = fit_turns(conversations)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    made = F.length(render(F.col("_role"), F.col("_text")))
    df = df.withColumn("_end", F.sum(made).over(order) - len(CLOSE))
    span = F.when(F.col("role") == "assistant", F.struct(
        (F.col("_end") - F.length("_text")).alias("start"), F.col("_end").alias("end")))
    one = F.struct("_end", "role", "text", render(F.col("_role"), F.col("_text")).alias("out"), span.alias("span"))
    whole = df.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("t"))
    whole = whole.withColumn("formatted", F.array_join(F.transform("t", lambda x: x["out"]), ""))
    source = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    whole = whole.withColumn("same", F.coalesce(parse(F.col("formatted")) == source, F.lit(False)))
    if strict:
        lost = F.raise_error(F.concat(F.lit("a conversation is lost in its formatted text: "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
        whole = whole.withColumn("formatted", F.when(F.col("same"), F.col("formatted")).otherwise(lost.cast("string")))
    return whole.select(
        "conv_id", "formatted",
        F.filter(F.transform("t", lambda x: x["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
        "same")


def digest(formatted: DataFrame) -> DataFrame:
    """Figures read back from the formatted text alone."""
    df = formatted.withColumn("_turns", parse(F.col("formatted")))
    said = F.array_join(F.transform(F.filter("_turns", lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")
    df = df.withColumn("_loss", said)
    line = F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return df.select(
        "conv_id", F.size("_turns").cast("long").alias("n_turns"), F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "same")
