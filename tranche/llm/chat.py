"""Chat formatting by rotation of perspectives.

Every participant of a conversation is once the assistant: its turns become the assistant's and are
what the loss is taken on, all other participants become named users, system turns stay. A rendering
comes in chunks of at most ``CHUNK`` turns; a conversation of fewer turns is one chunk. Turns are
numbered by a global sort, so a conversation that holds a large part of all rows is spread out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tranche.llm.sharding import numbered
from tranche.session import run_folder

CHUNK = 512
SYSTEM = "system"
# Fixed values of the format
BEGIN, END = "<|im_start|>", "<|im_end|>\n"


def rotated(conversations: DataFrame, chunk: int = CHUNK, system: str = SYSTEM) -> DataFrame:
    """One row per conversation, perspective and chunk: conv_id, perspective, chunk, turns, text, mask
    (spans [start, stop) of characters to learn: the assistant's texts with their end marks).

    Participants are the roles of a conversation other than ``system`` and null. A turn without role
    is a user's without name; a null text is empty. "<|" in a text gets a space, so no text can end a
    turn. Turns are ordered by number (nulls first), role and text; equal rows count each. A
    conversation without participants has no rendering; null conv_ids are one conversation. An empty
    table gives no rows. Other columns are not read.
    """
    folder = run_folder(conversations.sparkSession)
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    turns, _ = numbered(rows, order, f"{folder}/turns")
    first = turns.groupBy("conv_id").agg(F.min("row_number").alias("first")).withColumnRenamed("conv_id", "__conv")
    people = turns.where(F.col("role").isNotNull() & (F.col("role") != system)).select(
        F.col("conv_id").alias("__who"), F.col("role").alias("perspective")
    ).distinct()
    placed = turns.join(first, F.col("conv_id").eqNullSafe(F.col("__conv"))).select(
        "conv_id", "role", "text", (F.col("row_number") - F.col("first")).alias("place")
    )
    seen = placed.join(people, F.col("conv_id").eqNullSafe(F.col("__who"))).drop("__who")
    own = F.col("role").eqNullSafe(F.col("perspective"))
    head = (
        F.when(own, F.lit("assistant"))
        .when(F.col("role") == system, F.lit("system"))
        .otherwise(F.concat(F.lit("user"), F.coalesce(F.concat(F.lit(" name="), F.col("role")), F.lit(""))))
    )
    seen = seen.select(
        "conv_id", "perspective", "place", F.floor(F.col("place") / chunk).alias("chunk"), own.alias("own"),
        F.concat(F.lit(BEGIN), F.replace(head, F.lit("<|"), F.lit("< |")), F.lit("\n")).alias("head"),
        F.concat(F.replace(F.col("text"), F.lit("<|"), F.lit("< |")), F.lit(END)).alias("body"),
    )
    # At most ``chunk`` turns are gathered.
    parts = F.sort_array(F.collect_list(F.struct("place", "own", "head", "body")))
    grouped = seen.groupBy("conv_id", "perspective", "chunk").agg(parts.alias("parts"))

    def step(state, part):
        start = state["at"] + F.length(part["head"])
        stop = start + F.length(part["body"])
        span = F.array(F.struct(start.alias("start"), stop.alias("stop")))
        return F.struct(
            stop.alias("at"), F.when(part["own"], F.concat(state["mask"], span)).otherwise(state["mask"]).alias("mask")
        )

    nothing = F.array().cast("array<struct<start:int,stop:int>>")
    mask = F.aggregate("parts", F.struct(F.lit(0).alias("at"), nothing.alias("mask")), step, lambda s: s["mask"])
    return grouped.select(
        "conv_id", "perspective", "chunk", F.size("parts").cast("long").alias("turns"),
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"])), "").alias("text"),
        mask.alias("mask"),
    )
