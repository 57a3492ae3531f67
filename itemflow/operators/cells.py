"""Matrices in files, one cell each again."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from itemflow.functions.columns import cast_or_refuse
from itemflow.operators.joins import equi_join
from itemflow.operators.matrix import CELL, CODED_VARIABLES, NOT_SHOWN

# Fixed value: how matrices write a missing value.
MISSING = "NA"


def fields(line: Column, separator: str = ",") -> Column:
    """The fields of a line as an array of texts, without their quotes.

    A quoted field may hold separators and doubled quotes. A line break inside a field is
    not known: lines are read one by one.
    """
    field = f'[{separator}]("(?:[^"]++|"")*+"|[^{separator}]*+)'
    each = F.regexp_extract_all(F.concat(F.lit(separator), line), F.lit(field), F.lit(1))

    return F.transform(each, _plain)


def _plain(text: Column) -> Column:
    """A field without its quotes."""
    inner = text.substr(F.lit(2), F.char_length(text) - 2)
    return F.when(text.startswith('"'), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(text)


def _tokens(rest: Column, skip: str, separator: str) -> Column:
    """The fields after the id as tokens, each with its separator; a run of ``skip`` is one token."""
    gap = separator + skip
    plain_gap = re.escape(gap)
    token = f'((?:{plain_gap}(?![^{separator}]))++|[{separator}](?:"(?:[^"]++|"")*+"|[^{separator}]*+))'
    # a line without any other cell is told by one comparison
    width = F.floor(F.char_length(rest) / len(gap)).cast("int")
    empty = rest == F.repeat(F.lit(gap), width)
    nothing = F.when(width > 0, F.array(rest)).otherwise(F.array().cast("array<string>"))
    return F.when(empty, nothing).otherwise(F.regexp_extract_all(rest, F.lit(token), F.lit(1)))


def _is_run(token: Column, gap: str, separator: str) -> Column:
    return (token == gap) | token.startswith(gap + separator)


def _shown_cells(lines: DataFrame, headers: DataFrame, by: Sequence[str], id_column: str, skip: str, separator: str) -> DataFrame:
    """The cells of lines whose text is not ``skip``: only these take a place in an array, and a row.

    A line meets the length of its header and the text of a line without any other cell, to
    which it is compared whole; what is parsed is the other lines, and their cells, not
    lines, meet the names.
    """
    gap = separator + skip
    names = headers.select(*by, fields(F.col("value"), separator).alias("names")).distinct().withColumn("n_names", F.size("names"))
    empty = F.repeat(F.lit(gap), F.col("n_names") - 1)
    sizes = F.broadcast(names.select(*by, "n_names").distinct().withColumn("empty", empty))
    met = equi_join(lines.select(*by, "value"), sizes, by, "inner") if by else lines.select("value").join(sizes)
    # an id in quotes with a separator in it is too short here, so its line is parsed
    plain_id = F.substring_index("value", separator, 1)
    is_empty = (F.octet_length("value") == F.octet_length(plain_id) + F.octet_length("empty")) & F.col("value").endswith(F.col("empty"))
    met = met.where(~F.coalesce(is_empty, F.lit(False)))
    whole = F.concat(F.lit(separator), F.col("value"))
    first = F.regexp_extract(whole, f'^([{separator}](?:"(?:[^"]++|"")*+"|[^{separator}]*+))', 1)
    split = met.select(*by, "n_names", fields(F.substring(first, len(separator) + 1, 2**31 - 1), separator)[0].alias("id"), whole.substr(F.char_length(first) + 1, F.char_length(whole)).alias("rest"))
    width = F.transform("tokens", lambda t: F.when(_is_run(t, gap, separator), F.char_length(t) / len(gap)).otherwise(1).cast("int"))
    parsed = split.select(*by, "n_names", "id", _tokens(F.col("rest"), skip, separator).alias("tokens")).withColumn("widths", width)
    total = F.aggregate("widths", F.lit(0), lambda n, w: n + w)
    ends = F.aggregate("widths", F.array().cast("array<int>"), lambda all, w: F.concat(all, F.array(F.coalesce(F.try_element_at(all, F.lit(-1)), F.lit(0)) + w)))
    texts = F.transform("tokens", lambda t: F.substring(t, len(separator) + 1, 2**31 - 1))
    run = F.transform("tokens", lambda t: _is_run(t, gap, separator))
    cells = F.filter(F.arrays_zip(ends.alias("place"), texts.alias("text"), run.alias("run")), lambda c: ~c["run"])
    found = parsed.select(*by, "n_names", "id", (total + 1).alias("n_fields"), cells.alias("cells"))
    wrong = F.concat(F.lit("fields in a line: "), F.col("n_fields"), F.lit(", in its header: "), F.col("n_names"))
    checked = F.when(F.col("n_fields") == F.col("n_names"), F.col("cells")).otherwise(F.raise_error(wrong).cast(found.schema["cells"].dataType))
    student = F.nullif(F.col("id"), F.lit("")).alias(id_column)
    read = F.transform(checked, lambda c: F.struct(c["place"].alias("place"), _plain(c["text"]).alias("text")))
    shown = found.select(*by, "n_names", student, F.inline(read)).where(F.col("text") != skip)
    # the first name is that of the ids
    named = names.select(*by, "n_names", F.posexplode("names").alias("place", "content_item_name"))
    joined = equi_join(shown, named, [*by, "n_names", "place"], "inner")
    return joined.select(*by, id_column, "content_item_name", "text")


def cells_of_lines(
    lines: DataFrame, headers: DataFrame, by: Sequence[str] = (), id_column: str = "student_id", separator: str = ",", skip: str | None = None
) -> DataFrame:
    """(by..., student, item, text) from lines and headers, both (by..., value).

    ``by`` names the columns that tell one matrix, or block of it, from another. Headers
    are joined to lines, not to cells. A line with more or fewer fields than its header
    stops the run; an empty id is null. Cells whose text is ``skip`` have no row: a run of
    them is read as one field, so that a line costs its other cells.
    """
    if skip:
        return _shown_cells(lines, headers, by, id_column, skip, separator)
    names = headers.select(*by, fields(F.col("value"), separator).alias("names")).distinct()
    rows = lines.select(*by, fields(F.col("value"), separator).alias("fields"))
    # without ``by`` there is one header, and a task that reads lines can hold a line
    joined = equi_join(rows, names, by, "inner") if by else rows.join(F.broadcast(names))
    wrong = F.concat(F.lit("fields in a line: "), F.size("fields"), F.lit(", in its header: "), F.size("names"))
    checked = F.when(F.size("fields") == F.size("names"), F.col("fields")).otherwise(F.raise_error(wrong).cast("array<string>"))
    width = F.size("names") - 1
    pairs = F.arrays_zip(F.slice("names", F.lit(2), width).alias("item"), F.slice(checked, F.lit(2), width).alias("text"))
    student = F.nullif(F.element_at("fields", 1), F.lit("")).alias(id_column)
    return joined.select(*by, student, F.inline(pairs)).toDF(*by, id_column, "content_item_name", "text")


def cells_of_wide(wide: DataFrame, id_column: str = "student_id") -> DataFrame:
    """(student, item, text) from a frame with a column per item."""
    names = [c for c in wide.columns if c != id_column]
    text = wide.select(id_column, *[F.col(f"`{c}`").cast("string").alias(c) for c in names])
    return text.unpivot(id_column, names, "content_item_name", "text")


def long_of_cells(
    cells: DataFrame, variable: str, omit_code: str = "5", not_seen_code: str = "6", by: Sequence[str] = (), id_column: str = "student_id"
) -> DataFrame:
    """The long matrix (by..., student, item, seen, attempted, variable) of text cells.

    Cells of items that were not seen have no row, nor have empty ones, which stand for an
    exam not taken. An omitted cell is not attempted and counts as 0. ``NA`` is null; any
    other text that is no number stops the run. Codes have to differ from each other and
    from values: where omits were written as wrong answers they are read as such.
    """
    if variable not in CODED_VARIABLES:
        not_seen_code = NOT_SHOWN
    text = F.col("text")
    omitted = (text == omit_code) & F.lit(variable in CODED_VARIABLES)
    number = F.when(omitted, F.lit(0).cast("bigint")).when(text != MISSING, cast_or_refuse(F.when(~omitted & (text != MISSING), text), LongType(), variable))
    shown = cells.where(text.isNotNull() & (text != "") & (text != not_seen_code))
    return shown.select(
        *by,
        F.col(id_column).alias("student_id"),
        "content_item_name",
        F.lit(1).cast("bigint").alias("seen"),
        F.when(omitted, 0).otherwise(1).cast("bigint").alias("attempted"),
        number.alias(variable),
    )


def merged_longs(longs: dict[str, DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """One long matrix of several variables from one each, with a single shuffle.

    An item counts as attempted where no coded variable says that it was omitted.
    """
    every = None
    for name, long in longs.items():
        values = [F.col(name).alias(name) if v == name else F.lit(None).cast("bigint").alias(v) for v in longs]
        attempted = F.col("attempted") if name in CODED_VARIABLES else F.lit(None).cast("bigint")
        rows = long.select(*by, *CELL, "seen", attempted.alias("attempted"), *values)
        every = rows if every is None else every.unionByName(rows)
    return every.groupBy(*by, *CELL).agg(
        F.max("seen").alias("seen"), F.coalesce(F.min("attempted"), F.lit(1).cast("bigint")).alias("attempted"), *[F.max(v).alias(v) for v in longs]
    )
