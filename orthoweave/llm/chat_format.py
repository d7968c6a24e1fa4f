r"""Chat formatting: one rotation of a dialogue for every participant, with that speaker as the assistant.

A rotation is returned as its turns in order: rendered segment, whether its content is trained on, and the code-point
span of segment and content in the rotation's text. The text of a rotation is its segments put together; a dialogue of
any length needs no row or task that holds all of it. Each turn renders as ``<|im_start|>role`` (for others:
``user name=speaker``), a line end, the text, ``<|im_end|>`` and a line end.

A text or speaker can't forge a turn: a backslash parts ``<|im_`` within them into ``<\|im_``, and the line ends in a
speaker's name are blanks.

Cases: system turns are rendered as such in each rotation and have no rotation of their own; a null speaker is called
``unknown``, a null text is empty; rows of a dialogue go by turn (null first), then speaker, then text, and equal rows
are rendered as often as they occur; a dialogue without any speaker but the system gives no rotation; a null conv_id is
a dialogue like any other; a conv_id may be of any type, a turn that is no integer counts as null; a single turn has to
fit in a row, whatever the length of its dialogue; no rows give none; extra columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SYSTEM, TAIL = "system", "<|im_end|>\n"
#: Turn numbers of one range.
RANGE = 32


def safe(text: Column) -> Column:
    """Without the marks that begin and end a turn."""
    return F.replace(text, F.lit("<|im_"), F.lit("<\\|im_"))


def rotations(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text") -> DataFrame:
    """conv_id, perspective, position, turn, speaker, segment, trained, start, content_start, content_end, end, n_turns.

    Positions and offsets are prefix sums in two steps, over ranges of a dialogue and within each range, so that a hot
    dialogue is dealt over many tasks; equal rows are counted before the shuffle. The sums over ranges come from lengths
    alone; texts are shuffled by range once they are counted, and rotated where they then are.
    """
    told_by = safe(F.translate(F.coalesce(F.col(speaker).cast("string"), F.lit("unknown")), "\r\n", "  "))
    number = F.col(turn).try_cast("long")
    rows = turns.select(
        F.col(conv).alias("conv_id"), F.col(conv).isNull().alias("no_id"), F.coalesce(F.col(conv).cast("string"), F.lit("")).alias("id"), F.floor(F.coalesce(number, F.lit(-(2**62))) / RANGE).alias("range"), number.alias("turn"), told_by.alias("speaker"), safe(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("text")
    )
    lengths = rows.select("no_id", "id", "range", "speaker", F.length("text").cast("long").alias("chars"))
    rows = rows.groupBy("conv_id", "no_id", "id", "range", "turn", "speaker", "text").agg(F.count("*").alias("n"))

    head = F.concat(F.lit("<|im_start|>"), F.when(F.col("speaker") == SYSTEM, SYSTEM).when(F.col("speaker") == F.col("perspective"), "assistant").otherwise(F.concat(F.lit("user name="), F.col("speaker"))), F.lit("\n"))
    dialogue = ["no_id", "id"]
    per = lengths.groupBy(*dialogue, "range", "speaker").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))
    speakers = per.filter(F.col("speaker") != SYSTEM).select(*dialogue, F.col("speaker").alias("perspective")).distinct()
    sums = per.join(speakers, dialogue).groupBy(*dialogue, "range", "perspective").agg(F.sum(F.col("chars") + F.col("n") * (F.length(head) + len(TAIL))).alias("chars"), F.sum("n").alias("n"))
    before = W.partitionBy(*dialogue, "perspective").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    held = F.struct("perspective", F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("chars0"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows0"), F.sum("n").over(W.partitionBy(*dialogue, "perspective")).alias("n_turns"))
    held = sums.select(*dialogue, "range", held.alias("held")).groupBy(*dialogue, "range").agg(F.collect_list("held").alias("held"))

    told = rows.join(held, [*dialogue, "range"]).select("*", F.inline("held")).drop("held")
    told = told.withColumn("head", head).withColumn("segment", F.concat("head", "text", F.lit(TAIL))).withColumn("trained", F.col("speaker") == F.col("perspective")).withColumn("len", F.length("segment").cast("long"))
    here = W.partitionBy(*dialogue, "range", "perspective").orderBy("turn", "speaker", "text").rowsBetween(W.unboundedPreceding, -1)
    told = told.withColumn("chars1", F.col("chars0") + F.coalesce(F.sum(F.col("len") * F.col("n")).over(here), F.lit(0))).withColumn("rows1", F.col("rows0") + F.coalesce(F.sum("n").over(here), F.lit(0)))
    told = told.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    start = F.col("chars1") + F.col("copy") * F.col("len")
    return told.select(
        "conv_id",
        "perspective",
        (F.col("rows1") + F.col("copy")).alias("position"),
        "turn",
        "speaker",
        "segment",
        "trained",
        start.alias("start"),
        (start + F.length("head")).alias("content_start"),
        (start + F.length("head") + F.length("text")).alias("content_end"),
        (start + F.col("len")).alias("end"),
        "n_turns",
    )
