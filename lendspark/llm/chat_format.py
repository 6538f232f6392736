r"""Chat formatting with Spark expressions only.

A conversation's rows are collected as structs and sorted by turn; adjacent turns of the same
role become one block with an array of texts; blocks are concatenated:

    ### user: first text</turn>second text</turn>
    ### assistant: answer</turn>

Reversible escape: inside roles and texts ``\``, ``#`` and ``<`` are written ``\\``, ``\h`` and
``\l`` (in roles ``:`` is ``\c`` besides), so "### " and "</turn>" can only be the template's.

The loss mask are the spans (start, end: code points of the formatted string, half-open) of the
assistant's texts, one for each turn.

Order: turn (null first), then role, then text; repeated rows stay. Null text or role: empty
string. Null conv_id: a conversation of its own. Empty table: no rows. Other columns of the input
are not used. A conversation is one output row, so its turns meet in one task by definition; runs
of cumulated lengths come from a window over the same partitioning, linear in the turns.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD, COLON, END = "### ", ": ", "</turn>"


def escape(text: Column) -> Column:
    for plain, coded in (("\\", "\\\\"), ("#", "\\h"), ("<", "\\l")):
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    """Pairs of backslashes are read from the left; between them ``\\h``, ``\\l`` and ``\\c`` are marks."""
    def marks(part: Column) -> Column:
        for plain, coded in (("#", "\\h"), ("<", "\\l"), (":", "\\c")):
            part = F.replace(part, F.lit(coded), F.lit(plain))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\"), marks), "\\")


def format_chats(turns: DataFrame, *, loss_role: str = "assistant") -> DataFrame:
    """``turns`` (conv_id, turn, role, text): conv_id, n_turns, n_blocks, formatted, loss_spans."""
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).select("conv_id", "turn", "role", "text", escape(F.col("text")).alias("body"),
             F.replace(escape(F.col("role")), F.lit(":"), F.lit("\\c")).alias("name"))
    own = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    opens = F.coalesce(F.lag("role").over(own) != F.col("role"), F.lit(True))
    # where the turn's text begins: the header if its block opens here, and the line feed that closes the one before
    lead = F.when(F.col("opens"), F.char_length(F.concat(F.lit(HEAD), "name", F.lit(COLON)))
                  + F.when(F.col("place") > 1, 1).otherwise(0)).otherwise(0)
    placed = (
        rows.withColumn("place", F.row_number().over(own)).withColumn("opens", opens)
        .withColumn("lead", lead).withColumn("n", F.char_length("body"))
        .withColumn("end", F.sum((F.col("lead") + F.col("n") + len(END)).cast("long")).over(
            own.rowsBetween(Window.unboundedPreceding, 0)) - len(END))
    )
    turn = F.struct("place", "opens", "role", "name", "body", (F.col("end") - F.col("n")).alias("start"), "end")
    chats = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    first = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: F.get(F.col("turns"), i - 1)["opens"])
    blocks = F.transform("firsts", lambda at, k: F.struct(
        F.get(F.col("turns"), at - 1)["name"].alias("name"),
        F.slice("turns", at, F.coalesce(F.get(F.col("firsts"), k + 1), F.size("turns") + 1) - at)["body"].alias("bodies")))
    text = F.concat(F.array_join(F.transform("blocks", lambda b: F.concat(
        F.lit(HEAD), b["name"], F.lit(COLON), F.array_join(b["bodies"], END), F.lit(END))), "\n"), F.lit("\n"))
    spans = F.transform(F.filter("turns", lambda t: t["role"] == loss_role), lambda t: F.struct(t["start"], t["end"]))
    return (
        chats.withColumn("firsts", first).withColumn("blocks", blocks)
        .select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.size("blocks").cast("long").alias("n_blocks"),
                text.alias("formatted"), spans.alias("loss_spans"))
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted string holds, in order."""
    def block(b: Column) -> Column:
        texts = F.split(F.substring(b, F.instr(b, COLON) + F.lit(len(COLON)), F.char_length(b)), END)
        return F.transform(F.slice(texts, 1, F.size(texts) - 1), lambda t: F.struct(
            unescape(F.substring_index(b, ":", 1)).alias("role"), unescape(t).alias("text")))

    blocks = F.split(formatted, HEAD)
    return F.flatten(F.transform(F.slice(blocks, 2, F.size(blocks)), block))


def loss_text(formatted: Column, spans: Column) -> Column:
    """Unescaped text under the loss mask."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
