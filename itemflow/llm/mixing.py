"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words, and so every document of it the same
expected number of copies. The whole part of that number is taken as it is. The
fractions are rounded together: two documents meet, and words of expectation move at
random from one to the other until one of the two is a whole number; the other goes
on. Expectations are kept, and so is the sum of words, up to the last document of a
source. Documents meet in small blocks; what is left of 64 blocks meets in the next
level, a tree whose depth is the logarithm of the source.

Random numbers are hashes of documents and levels: a rerun takes the same documents.
Nothing but DataFrame expressions is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from itemflow.llm.common import match, saved, text_key

# Weights of sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK = 64
SEED = 20240501


def words_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Targets follow the weights, stop at ``MOST`` times the size, and share what is
    cut off by weight: a water level over the sources in order of cap by weight.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), place % len(WEIGHTS) + 1)
    named = sizes.withColumns({"weight": weight, "place": place}).withColumn("cap", (MOST * F.col("source_size")).cast("decimal(38,0)"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    whole = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = named.withColumns(
        {
            "left": (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("decimal(38,0)"),
            "weights": (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))).cast("decimal(38,0)"),
            "rank": F.row_number().over(by_ratio),
        }
    )
    fits = F.col("left") * F.col("weight") <= F.col("cap") * F.col("weights")
    at = level.withColumn("at", F.min(F.when(fits, F.col("rank"))).over(whole))
    pick = lambda c: F.max(F.when(F.col("rank") == F.col("at"), F.col(c))).over(whole)
    shared = at.withColumns({"left": pick("left"), "weights": pick("weights")})
    level_of = (F.col("left") * F.col("weight")).cast("double") / F.col("weights").cast("double")
    target = F.when(F.col("rank") < F.col("at"), F.col("cap").cast("double")).otherwise(level_of)
    return shared.select("source", "source_size", target.alias("target"))


def _uniform(*parts: Column) -> Column:
    """A number in (0, 1) from a hash."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *parts), 11).cast("double") + 0.5) / float(1 << 53)


def _meet(acc: Column, unit: Column, level: int) -> Column:
    """Two units meet; ``acc``: (unit, out), where the unit is null at first."""
    a, b = acc["unit"], unit
    up = F.least((1 - a["p"]) * a["size"], b["p"] * b["size"])
    down = F.least(a["p"] * a["size"], (1 - b["p"]) * b["size"])
    to_first = _uniform(F.lit(level), a["i"], a["k"], b["i"], b["k"]) * (up + down) < down
    moved = F.when(to_first, up).otherwise(-down)
    # the unit that reaches its bound first is decided
    first_done = F.when(to_first, (1 - a["p"]) * a["size"] <= b["p"] * b["size"]).otherwise(a["p"] * a["size"] <= (1 - b["p"]) * b["size"])
    bounded = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    rest_a = a.withField("p", bounded(a["p"] + moved / a["size"]))
    rest_b = b.withField("p", bounded(b["p"] - moved / b["size"]))
    done_a = a.withField("p", F.when(to_first, 1.0).otherwise(0.0))
    done_b = b.withField("p", F.when(to_first, 0.0).otherwise(1.0))
    met = F.struct(
        F.when(first_done, rest_b).otherwise(rest_a).alias("unit"),
        F.concat(acc["out"], F.array(F.when(first_done, done_a).otherwise(done_b))).alias("out"),
    )
    return F.when(a.isNull(), F.struct(b.alias("unit"), acc["out"].alias("out"))).otherwise(met)


UNIT = "struct<i:bigint,k:bigint,size:bigint,n:bigint,p:double>"


def _level(units: DataFrame, level: int) -> DataFrame:
    """(source, block, unit, out) of units (source, block, unit): each block folded into what is left of it."""
    order = F.struct(F.xxhash64(F.lit(SEED), F.col("unit.i"), F.col("unit.k")).alias("h"), F.col("unit").alias("unit"))
    blocks = units.groupBy("source", "block").agg(F.sort_array(F.collect_list(order)).alias("all"))
    start = F.struct(F.lit(None).cast(UNIT).alias("unit"), F.array().cast(f"array<{UNIT}>").alias("out"))
    folded = F.aggregate("all", start, lambda acc, x: _meet(acc, x["unit"], level))
    return blocks.select("source", "block", folded.alias("f")).select("source", "block", "f.unit", "f.out")


def _rounded(units: DataFrame, most: int) -> DataFrame:
    """(source, unit) with every p rounded to 0 or 1. ``most``: units of the largest source."""
    decided = []
    level = 0
    while True:
        done = saved(_level(units, level), "level")
        decided.append(done.select("source", F.explode("out").alias("unit")))
        most = -(-most // BLOCK)
        if most <= 1:
            break
        units = done.select("source", F.floor(F.col("block") / BLOCK).alias("block"), "unit")
        level += 1
    last = F.col("unit").withField("p", F.when(_uniform(F.lit(-1), F.col("unit.i"), F.col("unit.k")) < F.col("unit.p"), 1.0).otherwise(0.0))
    result = done.select("source", last.alias("unit"))
    for rows in decided:
        result = result.unionByName(rows)
    return result


def _documents(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("bigint").alias("i"), text_key(text).alias("k"), F.col(source).cast("string").alias("source"), words_of(text).alias("size"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(i, k, source, size, n, extra, whole, source_size, target) of each distinct document.

    i and k are doc_id and text key; n rows of the table are this document. Every row
    is taken ``whole`` times, and ``extra`` of the n rows once more.

    Null and empty texts have no words and are not taken; a source without words has
    the target 0. Null sources are one source, the last. Null doc_ids are told apart
    by a hash of the text. Rows that agree in doc_id, text and source are rounded
    together and get equal shares. An empty table gives an empty result. Other
    columns are not looked at.
    """
    rows = saved(_documents(docs, doc_id, text, source).groupBy("source", "i", "k", "size").agg(F.count("*").alias("n")), "sizes")
    sizes = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    aim = saved(targets(sizes), "targets")
    aim_named = aim.withColumnRenamed("source", "s")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    placed = rows.join(aim_named, match(rows, aim_named, {"source": "s"})).drop("s").withColumn("ratio", ratio)
    whole = F.when(F.col("size") > 0, F.floor("ratio")).otherwise(0)
    share = F.when(F.col("size") > 0, (F.col("ratio") - F.col("whole")) * F.col("n")).otherwise(0.0)
    placed = placed.withColumn("whole", whole).withColumn("share", share)
    unit = F.struct("i", "k", "size", "n", (F.col("share") - F.floor("share")).alias("p"))
    open_units = saved(placed.where(F.col("share") > F.floor("share")).select("source", unit.cast(UNIT).alias("unit")), "units")
    counts = saved(open_units.groupBy("source").agg(F.count("*").alias("units")), "counts")
    most = counts.agg(F.max("units")).first()[0]
    settled = placed.where(F.col("share") == F.floor("share")).select("source", "i", "k", "size", "n", F.lit(0).cast("bigint").alias("up"))
    if most:
        named = counts.withColumnRenamed("source", "s")
        block = F.pmod(F.xxhash64(F.lit(SEED + 1), F.col("unit.i"), F.col("unit.k")), F.ceil(F.col("units") / BLOCK))
        blocks = open_units.join(named, match(open_units, named, {"source": "s"})).select("source", block.alias("block"), "unit")
        rounded = _rounded(blocks, most).select("source", "unit.*")
        settled = settled.unionByName(rounded.select("source", "i", "k", "size", "n", F.col("p").cast("bigint").alias("up")))
    result = settled.join(aim_named, match(settled, aim_named, {"source": "s"})).drop("s").withColumn("ratio", ratio)
    result = result.withColumn("whole", whole.cast("bigint")).withColumn("share", share)
    extra = F.floor("share").cast("bigint") + F.col("up")
    return result.select("i", "k", "source", "size", "n", extra.alias("extra"), "whole", "source_size", "target")


def mixed_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row of the table.

    Nulls, empty texts, ties and an empty table as in ``mix``; of rows that repeat some
    may be taken once more than others.
    """
    each = mix(docs).withColumn("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))
    times = F.col("whole") + F.when(F.col("row") <= F.col("extra"), 1).otherwise(0)
    return each.select(F.col("i").alias("doc_id"), "size", "source_size", "target", (F.col("size") * times).alias("taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix, all columns, each as many times as it is taken.

    Nulls, empty texts, ties and an empty table as in ``mix``; a document that is not
    taken has no row. Columns may have any names: rows travel as a whole.
    """
    # nulls are inside the key, so that join and window agree on it and rows are dealt once
    key = lambda i, k, s: F.struct(i.alias("i"), k.alias("k"), s.alias("s")).cast("struct<i:bigint,k:bigint,s:string>").alias("key")
    plan = mix(docs).select(key(F.col("i"), F.col("k"), F.col("source")), "n", "extra", "whole")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("all"),
        key(F.col("doc_id"), text_key(), F.col("source")),
    )
    joined = rows.join(plan, "key")
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.lit(0)))
    times = F.col("whole") + F.when(F.when(F.col("n") == 1, F.lit(1)).otherwise(place) <= F.col("extra"), 1).otherwise(0)
    counted = joined.withColumn("times", times).where("times > 0")
    repeated = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times").cast("bigint"))))
    return repeated.select("all.*")
