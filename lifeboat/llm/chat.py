"""Chat formatting by multi-party perspective rotation (DataFrame functions only).

For every participant of a conversation the whole dialogue is rendered once
more with that participant as the assistant: own turns are assistant messages
and are trained on, the others' turns are user messages that carry their
speaker's name, system turns stay system messages. The rendering is one row per
message and perspective, in turn order, so a conversation of any length is
never gathered in one task; the dialogue is the messages' concatenation.

Defined results: null text counts as empty; a null role is the participant
``unknown``; rows of a null conversation are one conversation; turns without
number come first; repeated rows and rows of the same turn are messages of
their own. A conversation of system turns only has no perspective and gives no
row. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def rotate(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text",
           system: str = "system") -> DataFrame:
    """conv_id, perspective, turn, role, name, rendered, loss_start, loss_end, trained.

    ``loss_start`` and ``loss_end`` are the code points of ``rendered`` that
    carry loss: content and end mark of the assistant's own messages, nothing
    (both zero) elsewhere. Participants are the distinct speakers of a conversation
    (grouped, combined map-side), joined to its turns; a hot conversation is
    many turns against one short row, which AQE splits.
    """
    t = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
                     F.coalesce(F.col(speaker).cast("string"), F.lit("unknown")).alias("speaker"),
                     F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    people = (t.filter(F.col("speaker") != system).groupBy("conv_id")
              .agg(F.array_sort(F.collect_set("speaker")).alias("people")).withColumnRenamed("conv_id", "c"))
    own = F.col("speaker") == F.col("perspective")
    role = F.when(F.col("speaker") == system, "system").when(own, "assistant").otherwise("user")
    name = F.when((F.col("speaker") != system) & ~own, F.col("speaker"))
    head = F.concat(F.lit(START), F.col("role"), F.coalesce(F.concat(F.lit(" name="), F.col("name")), F.lit("")), F.lit("\n"))
    each = (t.join(people, t["conv_id"].eqNullSafe(people["c"]))
            .select("conv_id", "turn", "speaker", "text", F.explode("people").alias("perspective"))
            .withColumn("role", role).withColumn("name", name).withColumn("head", head))
    trained = F.col("role") == "assistant"
    return each.select(
        "conv_id", "perspective", "turn", "role", "name",
        F.concat("head", "text", F.lit(END + "\n")).alias("rendered"),
        F.when(trained, F.length("head")).otherwise(0).alias("loss_start"),
        F.when(trained, F.length("head") + F.length("text") + len(END)).otherwise(0).alias("loss_end"),
        trained.alias("trained"))
