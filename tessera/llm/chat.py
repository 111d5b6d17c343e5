r"""Chat formatting by prefix-target expansion, in DataFrame functions only.

A conversation is written as one text: per turn ``### <role>: <text> </turn>`` and a line feed.
Inside roles and texts every ``\``, ``#`` and ``<`` is replaced by ``\b``, ``\h`` and ``\l`` (and
``:`` by ``\c`` in roles), so the marks cannot occur there and the escape is undone exactly. Each
assistant turn becomes an example: its context is the conversation up to the reply's text, and only
the reply is trainable. Examples name their context and loss mask as spans of the formatted text,
so a long conversation is stored once and not once per reply; ``materialise`` writes the contexts
out. A conversation is one row, which bounds it by the size of a value; its turns meet in one task.

Defined cases: a null text or role counts as empty. Turns are ordered by ``turn`` (nulls first),
then role and text, so ties and repeated rows have a fixed order and all stay. Rows with a null
``conv_id`` form one conversation. A conversation without an assistant turn is formatted and has no
example. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

HEAD, MIDDLE, END = "### ", ": ", " </turn>\n"
TRAINABLE = "assistant"
_TEXT = [("\\", "\\b"), ("#", "\\h"), ("<", "\\l")]
_ROLE = [*_TEXT, (":", "\\c")]


def _replaced(col: Column, pairs) -> Column:
    for old, new in pairs:
        col = F.replace(col, F.lit(old), F.lit(new))
    return col


def escaped(col: Column, role: bool = False) -> Column:
    return _replaced(F.coalesce(col.cast("string"), F.lit("")), _ROLE if role else _TEXT)


def unescaped(col: Column) -> Column:
    """The backslash itself comes last: until then each one starts an escape."""
    return _replaced(col, [(new, old) for old, new in reversed(_ROLE)])


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``examples``, an array of
    (``context_turns``, ``loss_start``, ``loss_chars``), one for each assistant turn. Spans count
    code points of ``formatted``; an example's context is all that stands before its loss."""
    blocks = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    head = F.concat(F.lit(HEAD), escaped(F.col("role"), True), F.lit(MIDDLE))
    blocks = (blocks.withColumn("head", head).withColumn("body", escaped(F.col("text")))
              .withColumn("chars", F.length("head") + F.length("body") + len(END)))
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = blocks.select(
        "conv_id", (F.row_number().over(order) - 1).alias("at"), "role", "head", "body",
        F.coalesce(F.sum("chars").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    span = F.struct(F.col("at").alias("context_turns"), (F.col("start") + F.length("head")).alias("loss_start"),
                    F.length("body").cast("long").alias("loss_chars"))
    grouped = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("at", F.concat("head", "body", F.lit(END)).alias("block")))).alias("blocks"),
        F.array_sort(F.collect_list(F.when(F.col("role") == TRAINABLE, span))).alias("examples"))
    return grouped.select("conv_id", F.array_join(F.col("blocks.block"), "").alias("formatted"), "examples")


def parsed_turns(formatted: Column) -> Column:
    """The turns read back from a formatted text, as an array of (``role``, ``text``)."""
    def turn(block: Column) -> Column:
        at = F.instr(block, MIDDLE)
        return F.struct(unescaped(F.substring(block, F.lit(len(HEAD) + 1), at - len(HEAD) - 1)).alias("role"),
                        unescaped(F.substring(block, at + len(MIDDLE), F.length(block))).alias("text"))
    blocks = F.split(formatted, END)
    return F.transform(F.slice(blocks, F.lit(1), F.size(blocks) - 1), turn)


def prefix_target_examples(conversations: DataFrame, materialise: bool = False) -> DataFrame:
    """One row per assistant turn of formatted conversations: ``conv_id``, ``example`` (from 0),
    ``context_turns``, ``loss_start``, ``loss_chars`` and the masked ``target`` as it stands in the
    output; with ``materialise`` also ``context``. Without it the formatted text is read before the
    expansion and does not travel with every example."""
    text = F.col("formatted")

    def masked(e: Column) -> Column:
        return F.substring(text, (e["loss_start"] + 1).cast("int"), e["loss_chars"].cast("int"))
    spans = F.transform("examples", lambda e: F.struct(e["context_turns"].alias("context_turns"), e["loss_start"].alias("loss_start"),
                                                       e["loss_chars"].alias("loss_chars"), masked(e).alias("target")))
    rows = conversations.select("conv_id", *(["formatted"] if materialise else []), F.posexplode(spans).alias("example", "e"))
    out = rows.select("conv_id", "example", "e.*", *(["formatted"] if materialise else []))
    if not materialise:
        return out
    return out.withColumn("context", F.substring(text, F.lit(1), F.col("loss_start").cast("int"))).drop("formatted")


def digests(conversations: DataFrame) -> DataFrame:
    """Per formatted conversation what reading it back gives: number and digest of its turns, and
    the characters and digest of the text under the loss masks. That text is read from the expanded
    examples, one for each reply, and put together in their order; conversation and examples meet by
    the key the conversations are already dealt out by."""
    loss = (prefix_target_examples(conversations).groupBy(F.col("conv_id").alias("_conv"))
            .agg(F.array_sort(F.collect_list(F.struct("example", unescaped(F.col("target")).alias("text")))).alias("parts"))
            .select("_conv", F.array_join("parts.text", "").alias("loss")))
    turns = conversations.withColumn("turns", parsed_turns(F.col("formatted")))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = turns.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                        F.length("formatted").cast("long").alias("formatted_chars"))
    whole = read.join(loss, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").withColumn("loss", F.coalesce("loss", F.lit("")))
    return whole.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
