"""Quality rules with robust multivariate outliers.

Base rules look at one document: too few words, or too many words in repeated
five-word windows. Of the documents that pass them, a vector of four transformed
statistics is compared with its language and source: the minimum covariance
determinant gives the centre and the scatter of the best half of each group, and
documents too far from it by Mahalanobis distance are rejected.

All statistics are integers (logarithms times 1024, rounded), and so are their
sums and sums of products: results do not depend on the order of rows or on the
number of partitions. Nothing but DataFrame expressions is used.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from itemflow.llm.common import SPACE_CLASS, SPACES, saved

SYMBOLS = "#*$%&|<>"
WINDOW = 5
UNIT = 1024
Z = ("z1", "z2", "z3", "z4")
# Least spread, in natural logarithms, of any statistic: the scatter is not to be singular.
LEAST_SPREAD = 0.05
# Most documents of a group may have no symbols, repeated lines or repeated words at all, so that its half has no
# spread there. The least spread of these is that of a normal variable which stays within the value that 99 of 100
# documents do not exceed; but not more than this, so that far documents cannot widen it without bound.
MOST_SPREAD = 0.3
WITHIN = (99, 100)
DEVIATIONS = 2.576
# Of the queries; the function's default keeps all but the farthest documents.
CUTOFF = 0.999
# A group of fewer documents has no half to fit; such groups of a language are fitted together,
# and if these are few as well, such groups of all languages.
LEAST_GROUP = 40
GROUP = ["g_level", "g_lang", "g_source"]
STEPS = 6


def _statistics(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    """The kept columns, and a struct ``s`` of the counts of each text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    framed = docs.select(*[F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)], whole.alias("t"))
    trimmed = framed.withColumn("b", F.btrim("t", F.lit(SPACES)))
    words = trimmed.withColumn("w", F.when(F.col("b") == "", F.array().cast("array<string>")).otherwise(F.split("b", f"{SPACE_CLASS}+")))
    counted = words.select(
        *[c for c in framed.columns if c != "t"],
        "w",
        F.size("w").cast("bigint").alias("n_words"),
        F.char_length(F.translate("t", SPACES, "")).cast("bigint").alias("word_chars"),
        (F.char_length("t") - F.char_length(F.translate("t", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("l"),
    )
    five = lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(WINDOW)])
    windows = counted.withColumns(
        {
            "h": F.when(F.col("n_words") >= WINDOW, F.transform(F.sequence(F.lit(0), F.size("w") - WINDOW), five)).otherwise(F.array().cast("array<bigint>")),
            "n_lines": F.size("l").cast("bigint"),
            "n_dup_lines": (F.size("l") - F.size(F.array_distinct("l"))).cast("bigint"),
        }
    ).drop("w", "l")
    # only texts with a repeated window are sorted
    placed = windows.withColumn(
        "o",
        F.when(
            F.size(F.array_distinct("h")) < F.size("h"),
            F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
        ),
    ).drop("h")
    same = lambda x, i: F.coalesce(F.get("o", i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get("o", i + 1)["h"] == x["h"], F.lit(False))
    repeated = placed.withColumn("r", F.when(F.col("o").isNotNull(), F.sort_array(F.transform(F.filter("o", same), lambda x: x["i"])))).drop("o")
    start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    step = lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last"))
    covered = F.when(F.col("r").isNotNull(), F.aggregate("r", start, step, lambda a: a["n"])).otherwise(0)
    return repeated.withColumn("n_repeat_words", covered.cast("bigint")).drop("r")


def _vector(n: Column, chars: Column, symbols: Column, lines: Column, dup: Column, repeat: Column) -> list[Column]:
    logs = [
        F.log(F.greatest(chars, F.lit(1)) / F.greatest(n, F.lit(1))),
        F.log1p(20 * symbols / (n + 20)),
        F.log1p(10 * dup / (lines + 10)),
        F.log1p(10 * repeat / (n + 50)),
    ]
    return [F.round(x * UNIT).cast("bigint") for x in logs]


def chi_square_below(x: float, degrees: int) -> float:
    """Distribution of chi-square for an even number of degrees of freedom."""
    half = x / 2
    return 1 - math.exp(-half) * sum(half**k / math.factorial(k) for k in range(degrees // 2))


def chi_square_at(p: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    while high - low > 1e-9:
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_below(middle, degrees) < p else (low, middle)
    return high


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(Z)) for j in range(i + 1)]


def _moments() -> list[Column]:
    """Sums over weighted vectors; exact, since all terms are integers."""
    n = F.col("n")
    sums = [F.sum(n * F.col(z)).alias(f"s{i}") for i, z in enumerate(Z)]
    products = [F.sum(n * F.col(Z[i]) * F.col(Z[j])).alias(f"p{i}{j}") for i, j in _pairs()]
    return [F.sum(n).alias("m"), *sums, *products]


def spreads(vectors: DataFrame) -> list[float]:
    """Least spread of each statistic, over all documents: four numbers."""
    long = vectors.select("n", F.posexplode(F.array(*Z)).alias("d", "z")).where("d > 0")
    most = {r.d: r.median / UNIT / DEVIATIONS for r in _medians(long, ["d"], "z", WITHIN).collect()}
    return [min(MOST_SPREAD, max(LEAST_SPREAD, most.get(d, 0.0))) for d in range(len(Z))]


def _fit(moments: DataFrame, factor: float, group: list[str], least: list[float]) -> DataFrame:
    """Centre, Cholesky factor and log determinant from the moments of a subset."""
    m = F.col("m").cast("double")
    centre = {f"c{i}": F.col(f"s{i}") / m for i in range(len(Z))}
    frame = moments.withColumns(centre)
    cov = {}
    for i, j in _pairs():
        value = factor * (F.col(f"p{i}{j}") / m - F.col(f"c{i}") * F.col(f"c{j}"))
        cov[f"v{i}{j}"] = value + F.lit((least[i] * UNIT) ** 2) if i == j else value
    frame = frame.withColumns(cov)
    return _factored(frame, group)


def _factored(frame: DataFrame, group: list[str]) -> DataFrame:
    for j in range(len(Z)):
        squares = reduce(lambda a, b: a + b, [F.col(f"l{j}{k}") ** 2 for k in range(j)], F.lit(0.0))
        frame = frame.withColumn(f"l{j}{j}", F.sqrt(F.greatest(F.col(f"v{j}{j}") - squares, F.lit(1.0))))
        rest = {}
        for i in range(j + 1, len(Z)):
            dot = reduce(lambda a, b: a + b, [F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)], F.lit(0.0))
            rest[f"l{i}{j}"] = (F.col(f"v{i}{j}") - dot) / F.col(f"l{j}{j}")
        if rest:
            frame = frame.withColumns(rest)
    det = reduce(lambda a, b: a + b, [F.log(F.col(f"l{i}{i}")) for i in range(len(Z))])
    return frame.select(*group, *[f"c{i}" for i in range(len(Z))], *[f"l{i}{j}" for i, j in _pairs()], det.alias("det"))


def _distance() -> Column:
    """Squared Mahalanobis distance: forward substitution with the Cholesky factor."""
    y: list[Column] = []
    for i, z in enumerate(Z):
        dot = reduce(lambda a, b: a + b, [F.col(f"l{i}{k}") * y[k] for k in range(i)], F.lit(0.0))
        y.append((F.col(z) - F.col(f"c{i}") - dot) / F.col(f"l{i}{i}"))
    return reduce(lambda a, b: a + b, [v * v for v in y])


def _with_fit(vectors: DataFrame, fit: DataFrame, group: list[str], how: str = "inner") -> DataFrame:
    fit = fit.withColumnsRenamed({g: f"f_{g}" for g in group})
    condition = reduce(lambda a, b: a & b, [vectors[g].eqNullSafe(fit[f"f_{g}"]) for g in group])
    return vectors.join(fit, condition, how).drop(*[f"f_{g}" for g in group])


def _medians(values: DataFrame, group: list[str], value: str, share: tuple[int, int] = (1, 2)) -> DataFrame:
    """Lower weighted median, or another quantile, per group; the distinct integers of a group are few."""
    counts = values.groupBy(*group, value).agg(F.sum("n").alias("n"))
    over = Window.partitionBy(*group)
    ranked = counts.withColumns({"below": F.sum("n").over(over.orderBy(value)), "all": F.sum("n").over(over)})
    return ranked.where(share[1] * F.col("below") >= share[0] * F.col("all")).groupBy(*group).agg(F.min(value).alias("median"))


def _starts(vectors: DataFrame, least: list[float]) -> DataFrame:
    """Two deterministic starts per group: medians with median deviations, and plain moments."""
    group = GROUP
    long = vectors.select(*group, "n", F.posexplode(F.array(*Z)).alias("d", "z"))
    middle = _medians(long, [*group, "d"], "z").withColumnsRenamed({g: f"m_{g}" for g in [*group, "d"]})
    condition = reduce(lambda a, b: a & b, [long[g].eqNullSafe(middle[f"m_{g}"]) for g in [*group, "d"]])
    away = long.join(middle, condition).select(*group, "d", "n", "median", F.abs(F.col("z") - F.col("median")).alias("a"))
    spread = _medians(away.withColumnRenamed("median", "centre"), [*group, "d", "centre"], "a")
    wide = spread.groupBy(*group).pivot("d", list(range(len(Z)))).agg(F.max("centre").alias("c"), F.max("median").alias("v"))
    values = {f"c{i}": F.col(f"{i}_c").cast("double") for i in range(len(Z))}
    for i, j in _pairs():
        values[f"v{i}{j}"] = (1.4826 * F.col(f"{i}_v")) ** 2 + F.lit((least[i] * UNIT) ** 2) if i == j else F.lit(0.0)
    robust = _factored(wide.withColumns(values), group).withColumn("start", F.lit(0))
    plain = _fit(vectors.groupBy(*group).agg(*_moments()), 1.0, group, least).withColumn("start", F.lit(1))
    return robust.unionByName(plain)


def fitted(vectors: DataFrame) -> DataFrame:
    """Centre and scatter of each group by minimum covariance determinant.

    ``vectors``: the columns of ``GROUP``, z1 to z4, n (documents with this vector). A step
    takes the half of each group that is nearest under the last fit, and fits anew.
    Distances are binned (32 bins for a factor of e), so that the half is a count
    per bin: a group is summed before it is shuffled and never sorted or gathered.
    Documents of the bin at the edge all belong to the half.
    """
    group = [*GROUP, "start"]
    twice = vectors.withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    half = consistency(0.5)
    least = spreads(vectors)
    fit = saved(_starts(vectors, least), "fit")
    for _ in range(STEPS):
        fit = saved(_fit(_nearest(_with_fit(twice, fit, group), group), half, group, least), "fit")
    rank = Window.partitionBy(*GROUP).orderBy("det", "start")
    best = fit.withColumn("rank", F.row_number().over(rank)).where("rank = 1").drop("rank", "start", "det")
    # one more fit, of all documents that are not far away, uses more than half of the group
    group = GROUP
    able = vectors.groupBy(*group).agg(F.sum("n").alias("all")).where(F.col("all") >= LEAST_GROUP).drop("all")
    near = _with_fit(_with_fit(vectors, best, group), able, group).where(_distance() <= chi_square_at(0.975, len(Z)))
    return saved(_fit(near.groupBy(*group).agg(*_moments()), consistency(0.975), group, least).drop("det"), "fit")


def consistency(share: float) -> float:
    """Makes the scatter of the nearest share of normal data that of all of it."""
    return share / chi_square_below(chi_square_at(share, len(Z)), len(Z) + 2)


def _nearest(rows: DataFrame, group: list[str]) -> DataFrame:
    """Moments of the nearest half of each group."""
    bins = rows.withColumn("bin", F.floor(32 * F.log(_distance() + 1e-6)))
    summed = bins.groupBy(*group, "bin").agg(*_moments())
    over = Window.partitionBy(*group)
    before = over.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    placed = summed.withColumns({"before": F.coalesce(F.sum("m").over(before), F.lit(0)), "all": F.sum("m").over(over)})
    names = ["m", *[f"s{i}" for i in range(len(Z))], *[f"p{i}{j}" for i, j in _pairs()]]
    return placed.where(2 * F.col("before") < F.col("all")).groupBy(*group).agg(*[F.sum(x).alias(x) for x in names])


def _levels(rows: DataFrame) -> DataFrame:
    """(g_lang, g_source, g_level): 0 if the group has documents enough, 1 if the small groups of its language have, else 2."""
    counts = rows.groupBy("g_lang", "g_source").agg(F.count("*").alias("n"))
    small = F.sum(F.when(F.col("n") < LEAST_GROUP, F.col("n"))).over(Window.partitionBy("g_lang"))
    level = F.when(F.col("n") >= LEAST_GROUP, 0).when(small >= LEAST_GROUP, 1).otherwise(2)
    return saved(counts.withColumn("g_level", level).drop("n"), "levels")


def quality_verdicts(docs: DataFrame, keep: list[str], cutoff: float = 1 - 1e-8, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The kept columns of every row, its counts, ``base_failed`` and ``kept``.

    ``cutoff``: a document is rejected if a normal vector of its group would be
    nearer to the centre with at least this probability.

    Null text: no words, so the base rules fail it. Null language or source: a
    group of its own. Very long texts are counted whole. Rows that repeat count
    each; ties in distance fall into the same bin. Groups of fewer than 40
    documents that pass the base rules are fitted together with others, first of their
    language, then of all; fewer than 40 in all are not judged by distance. An empty table
    gives an empty result. A kept column that has the name of a result column is
    replaced by it; other columns are not looked at.
    """
    asked = [lang, source, *keep]
    counted = saved(_statistics(docs, asked, text), "statistics")
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    z = _vector(*[F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")])
    rows = counted.withColumnsRenamed({"k_0": "g_lang", "k_1": "g_source"}).withColumns(dict(zip(Z, z)) | {"base_failed": base})
    rows = _with_fit(rows, _levels(rows.where(~F.col("base_failed"))), ["g_lang", "g_source"], "left")
    level = F.col("g_level")
    rows = rows.withColumns({"g_lang": F.when(level < 2, F.col("g_lang")), "g_source": F.when(level < 1, F.col("g_source"))})
    vectors = saved(rows.where(~F.col("base_failed")).groupBy(*GROUP, *Z).agg(F.count("*").alias("n")), "vectors")
    result = _with_fit(rows, fitted(vectors), GROUP, "left")
    far = F.coalesce(_distance() > chi_square_at(cutoff, len(Z)), F.lit(False))
    result = result.withColumn("kept", ~F.col("base_failed") & ~far)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    kept = [F.col(f"k_{i + 2}").alias(c) for i, c in enumerate(keep) if c not in names]
    return result.select(*kept, *names)
