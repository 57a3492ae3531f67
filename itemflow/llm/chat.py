"""Perspective rotation: a dialogue as each of its participants would continue it.

For every participant the dialogue is rendered once more, with that speaker as the
assistant and all others as named users; the mask holds the spans of the text that
the assistant is trained on. Nothing but DataFrame expressions is used.

A dialogue of any length is rendered in pieces of a bounded number of turns. Turns
are numbered by a sort over range partitions, so that no dialogue has to fit into a
task; only pieces are ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from itemflow.llm.common import match, saved

PIECE_TURNS = 128
BOUND_CHARS = 64
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SYSTEM = "system"


def plain(text: Column) -> Column:
    """A text or name in which no marker of the format can stand."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _numbered(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(c, speaker, text, number): turns of each dialogue, numbered from 0."""
    rows = turns.select(F.col(conv_id).alias("c"), F.col(turn).alias("at"), plain(F.col(role)).alias("speaker"), plain(F.col(text)).alias("text"))
    order = [F.col("c"), F.col("at").asc_nulls_last(), F.col("speaker")]
    # bounds are sampled: they hold the beginnings of texts only
    ordered = rows.repartitionByRange(*order, F.left("text", F.lit(BOUND_CHARS))).sortWithinPartitions(*order, "text")
    placed = saved(ordered.select("c", "speaker", "text", F.monotonically_increasing_id().alias("place")), "turns")
    placed = placed.withColumn("part", F.shiftright("place", 33))
    firsts = saved(placed.groupBy("c", "part").agg(F.min("place").alias("first"), F.count("*").alias("n")), "firsts")
    # one row for each dialogue and range partition
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = firsts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first"))
    offsets = offsets.select(F.col("c").alias("o_c"), F.col("part").alias("o_part"), "offset")
    joined = placed.join(offsets, match(placed, offsets, {"c": "o_c", "part": "o_part"}))
    return joined.select("c", "speaker", "text", (F.col("place") + F.col("offset")).alias("number"))


def _head(turn: Column, participant: Column) -> Column:
    name = turn["speaker"]
    line = F.when(name == participant, F.lit("assistant")).when(F.lower(name) == SYSTEM, F.lit(SYSTEM)).otherwise(F.concat(F.lit("user name="), name))
    return F.concat(F.lit(OPEN), line, F.lit("\n"))


def rotate(turns: DataFrame, piece_turns: int = PIECE_TURNS, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, participant, piece, n_turns, text, mask), one row per participant and piece.

    ``mask``: spans of characters, from and to, of what the assistant says, with the
    closing marker. Turns follow each other by number, then speaker, then text; null
    numbers come last. System turns stay what they are and take no part; a dialogue
    of nothing else has no row. A null speaker has the empty name, a null text is
    empty; null ids are one dialogue. Rows that repeat are turns each. Markers inside
    texts and names are broken by a space. Texts are rendered whole. An empty table
    gives an empty result; other columns are not looked at.
    """
    numbered = _numbered(turns, conv_id, turn, role, text)
    pieces = numbered.groupBy("c", F.floor(F.col("number") / piece_turns).alias("piece")).agg(
        F.sort_array(F.collect_list(F.struct("number", "speaker", "text"))).alias("turns")
    )
    speakers = turns.select(F.col(conv_id).alias("p_c"), plain(F.col(role)).alias("participant")).where(F.lower("participant") != SYSTEM).distinct()
    each = pieces.join(speakers, match(pieces, speakers, {"c": "p_c"}))
    said = F.transform("turns", lambda t: F.struct(_head(t, F.col("participant")).alias("head"), F.concat(t["text"], F.lit(CLOSE)).alias("body"), (t["speaker"] == F.col("participant")).alias("own")))
    rendered = each.select("c", "participant", "piece", F.size("turns").cast("bigint").alias("n_turns"), said.alias("said"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<from:int,to:int>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + F.char_length(t["head"])
        end = begin + F.char_length(t["body"])
        span = F.array(F.struct(begin.alias("from"), end.alias("to")))
        return F.struct(end.alias("at"), F.when(t["own"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return rendered.select(
        F.col("c").alias("conv_id"),
        "participant",
        F.col("piece").cast("bigint").alias("piece"),
        "n_turns",
        F.array_join(F.transform("said", lambda t: F.concat(t["head"], t["body"])), "").alias("text"),
        F.aggregate("said", start, step, lambda acc: acc["spans"]).alias("mask"),
    )
