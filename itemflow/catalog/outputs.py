"""Summaries, matrices and combined matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from itemflow.catalog.registry import query, rounded
from itemflow.catalog.scores import ratio_sql
from itemflow.catalog.tables import (
    CONTENT_SQL,
    content_items,
    response_parts,
    responses,
    table,
    test_map,
    test_map_sql,
    with_responses,
)
from itemflow.functions.checkpoints import stored
from itemflow.functions.parts import dealt, text_parts
from itemflow.operators import cells, combine, matrix, metadata, omissions, rows, scoring
from itemflow.operators.answer_key import given_keys

# Items of the wide matrices: the last two digits of an item's name, so that the
# whole table goes into a fixed number of columns.
UNITS = [f"unit_{i:02d}" for i in range(100)]
TENS = [f"unit_{i}" for i in range(10)]


def _cleaned(spark, sf_dir, digits: int = 0):
    parts = response_parts(spark, sf_dir)
    frame = dealt(responses(spark, sf_dir, parts), parts, *omissions.SHOWING)
    kept, _ = omissions.repeat_questions(omissions.add_attempted(rows.drop_staged(frame)))
    if digits:
        ending = F.substring(F.col("content_item_name"), 12 - digits, digits)
        kept = kept.withColumn("content_item_name", F.concat(F.lit("unit_"), ending))
    return kept


def _cleaned_sql(digits: int = 0) -> str:
    name = f"concat('unit_', substr(content_item_name, {12 - digits}, {digits}))" if digits else "content_item_name"
    return (
        "with shown as (select *, row_number() over (partition by content_item_id, student_id "
        "order by timestamp_created, response_id) > 1 as repeat_omitted from responses "
        "where content_item_id <> -1), cleaned as (select * replace ("
        "case when repeat_omitted then 0 else raw_response end as raw_response, "
        "case when repeat_omitted then 0 else scored_response end as scored_response, "
        f"{name} as content_item_name), "
        "not repeat_omitted and coalesce(raw_response <> 0, false) as attempted, "
        "milliseconds_used * case when repeat_omitted then 0 else 1 end as milliseconds_used_fixed "
        "from shown)"
    )


def _strict(column: str) -> str:
    return f"case when count({column}) = count(*) then cast(sum({column}) as bigint) end"


# Summaries ------------------------------------------------------------------------


@query(
    "activity_info",
    with_responses(
        f"{_cleaned_sql()}, a as (select activity_id_hist as a_id, "
        "count(*) filter (attempted) as template_num_attempted, "
        f"{_strict('scored_response')} as template_raw_correct from cleaned group by activity_id_hist) "
        "select distinct student_id, activity_id, timestamp_created, timestamp_completed, c.template_name, "
        "template_num_attempted, template_raw_correct, "
        + ratio_sql("template_raw_correct", "num_ques", "template_pTotal") + ", "
        + ratio_sql("template_raw_correct", "template_num_attempted", "template_pPlus")
        + f" from cleaned c join a on a_id = activity_id_hist join {test_map_sql(None)} m "
        "on m.template_name = c.template_name"
    ),
)
def activity_info(spark, sf_dir):
    mapped = rows.join_test_map(_cleaned(spark, sf_dir), test_map(spark, sf_dir, None))
    info = metadata.activity_info(scoring.activity_scores(mapped))
    return rounded(info, "template_pTotal", "template_pPlus")


@query(
    "user_info",
    with_responses(
        f"{_cleaned_sql()}, u as (select student_id, count(distinct template_name) as num_seq_taken, "
        f"(select sum(num_ques)::bigint from {test_map_sql(None)} m) as test_total, count(*) as test_seen, "
        f"count(*) filter (attempted) as test_att, {_strict('scored_response')} as test_correct, "
        "min(timestamp_created) as first_test_date, max(timestamp_created) as last_test_date "
        "from cleaned group by student_id) select *, "
        + ratio_sql("test_correct", "test_seen", "test_ptotal") + ", "
        + ratio_sql("test_correct", "test_att", "test_pplus") + " from u"
    ),
)
def user_info(spark, sf_dir):
    info = metadata.user_info(_cleaned(spark, sf_dir), test_map(spark, sf_dir, None))
    return rounded(info, "test_ptotal", "test_pplus")


@query(
    "item_info",
    with_responses(
        f"{_cleaned_sql()}, i as (select content_item_id, content_item_name, template_name, template_id, "
        "item_section_position, count(*) filter (attempted) as count_att, count(*) as count_seen, "
        f"{_strict('scored_response')} as num_correct, min(timestamp_created) as first_date, "
        "max(timestamp_created) as last_date from cleaned group by all) "
        "select i.*, c.brand, k.correct_answer from i "
        f"left join (select content_item_id, content_item_name, brand from {CONTENT_SQL} x) c "
        "on c.content_item_id = i.content_item_id and c.content_item_name = i.content_item_name "
        "left join (select distinct content_item_id, correct_answer from cleaned) k "
        "on k.content_item_id = i.content_item_id"
    ),
)
def item_info(spark, sf_dir):
    content = content_items(spark, sf_dir).select("content_item_id", "content_item_name", "brand")
    # repeats keep their given answers: the key is read from the same rows before these are dealt by showing
    key = given_keys(rows.drop_staged(responses(spark, sf_dir)))
    return metadata.item_info(_cleaned(spark, sf_dir), key, content)


# Matrices -------------------------------------------------------------------------


_VARIABLES = ["scored_response", "raw_response", "milliseconds_used_fixed"]
_LONG = (
    "cells as (select student_id, content_item_name, count(*) as seen, "
    "count(*) filter (attempted) as attempted, "
    + ", ".join(f"{_strict(v)} as {v}" for v in _VARIABLES)
    + " from cleaned group by student_id, content_item_name)"
)


def _long(frame):
    return matrix.matrix_long(omissions.zero_repeats(frame, ["milliseconds_used"]), _VARIABLES)


@query("matrix_long", with_responses(f"{_cleaned_sql()}, {_LONG} select * from cells"))
def matrix_long(spark, sf_dir):
    return _long(_cleaned(spark, sf_dir))


def _code(variable: str, omit: str = ".") -> str:
    text = f"coalesce(cast({variable} as varchar), 'NA')"
    if variable in matrix.CODED_VARIABLES:
        return f"case when attempted = 0 then '{omit}' else {text} end"
    return text


def _wide_sql(variable: str, omit: str, not_seen: str, where: str = "true") -> str:
    columns = ", ".join(
        f"nullif(coalesce(max(code) filter (content_item_name = '{u}'), '{not_seen}'), 'NA') as \"{u}\""
        for u in UNITS
    )
    long = _LONG.replace("from cleaned", f"from cleaned where {where}")
    return with_responses(
        f"{_cleaned_sql(2)}, {long}, coded as (select student_id, content_item_name, "
        f"{_code(variable, omit)} as code from cells) select student_id, {columns} from coded group by student_id"
    )


for _name, _variable in {
    "matrix_scores": "scored_response",
    "matrix_responses": "raw_response",
    "matrix_ms": "milliseconds_used_fixed",
}.items():
    _unseen = "-99" if _variable in matrix.CODED_VARIABLES else "."

    @query(_name, _wide_sql(_variable, ".", _unseen))
    def matrix_of(spark, sf_dir, variable=_variable):
        parts = response_parts(spark, sf_dir)
        cleaned = dealt(_cleaned(spark, sf_dir, 2), parts, *matrix.CELL)
        return matrix.matrix_wide(_long(cleaned), variable, UNITS, ".", "-99", parts)


@query("matrix_omit_incorrect", _wide_sql("scored_response", "0", ".", "milliseconds_used > 0"))
def matrix_omit_incorrect(spark, sf_dir):
    parts = response_parts(spark, sf_dir)
    return matrix.omit_incorrect_matrix(dealt(_cleaned(spark, sf_dir, 2), parts, *matrix.CELL), UNITS, parts)


_ORDER = (
    "ordered as (select content_item_name, row_number() over (order by template_name, position, "
    "content_item_name) as display_position from (select content_item_name, template_name, "
    "item_section_position as position, row_number() over (partition by content_item_name "
    "order by template_name, item_section_position) as n from cleaned) f where n = 1)"
)


@query("item_display_order", with_responses(f"{_cleaned_sql()}, {_ORDER} select * from ordered"))
def item_display_order(spark, sf_dir):
    return matrix.display_order(_cleaned(spark, sf_dir))


def _lines_sql(variable: str, not_seen: str) -> str:
    return with_responses(
        f"{_cleaned_sql()}, {_LONG}, {_ORDER}, dense as (select s.student_id, display_position, "
        f"case when c.seen is null then '{not_seen}' else {_code(variable)} end as code "
        "from (select distinct student_id from cleaned) s cross join ordered o "
        "left join cells c on c.student_id = s.student_id and c.content_item_name = o.content_item_name) "
        "select student_id, string_agg(code, ',' order by display_position) as line from dense "
        "group by student_id"
    )


def _text_parts(spark, sf_dir, cell_bytes: int) -> int | None:
    """Parts for the lines of all students, from the rows of the tables of students and of items."""
    students, items = (table(spark, sf_dir, name).count() for name in ("customer", "part"))
    return text_parts(students, items, cell_bytes)


for _name, _variable in {
    "matrix_lines_scores": "scored_response",
    "matrix_lines_ms": "milliseconds_used_fixed",
}.items():

    @query(_name, _lines_sql(_variable, "-99" if _variable in matrix.CODED_VARIABLES else "."))
    def matrix_lines_of(spark, sf_dir, variable=_variable):
        cleaned = _cleaned(spark, sf_dir)
        parts = _text_parts(spark, sf_dir, 4 if variable in matrix.CODED_VARIABLES else 2)
        return matrix.matrix_lines(_long(cleaned), variable, matrix.display_order(cleaned), ".", "-99", parts=parts)


_BLOCK = 100


def _block_lines_sql(variable: str, not_seen: str) -> str:
    return with_responses(
        f"{_cleaned_sql()}, {_LONG}, {_ORDER}, dense as (select s.student_id, display_position, "
        f"case when c.seen is null then '{not_seen}' else {_code(variable)} end as code "
        "from (select distinct student_id from cleaned) s cross join ordered o "
        "left join cells c on c.student_id = s.student_id and c.content_item_name = o.content_item_name) "
        f"select student_id, (display_position - 1) // {_BLOCK} as block, "
        "string_agg(code, ',' order by display_position) as line from dense group by all"
    )


@query("matrix_block_lines", _block_lines_sql("scored_response", "-99"))
def matrix_block_lines(spark, sf_dir):
    cleaned = _cleaned(spark, sf_dir)
    blocks = matrix.in_blocks(matrix.display_order(cleaned), _BLOCK)
    # read for its cells and its students
    return matrix.block_lines(stored(_long(cleaned)), "scored_response", blocks, ".", "-99", parts=_text_parts(spark, sf_dir, 4))


def _summary_sql(variable: str) -> str:
    value = f"case when c.seen is null then 0 else {variable} end"
    return (
        f"select '{variable}' as variable, count(v) as n_values, cast(min(v) as double) as minimum, "
        "round(quantile_cont(v, 0.25), 6) as q1, round(quantile_cont(v, 0.5), 6) as median, "
        "round(avg(v), 6) as mean, round(quantile_cont(v, 0.75), 6) as q3, "
        "cast(max(v) as double) as maximum, count(distinct student_id) as n_students, "
        "count(distinct content_item_name) as n_items from "
        f"(select s.student_id, i.content_item_name, {value} as v from "
        "(select distinct student_id from cleaned) s cross join (select distinct content_item_name from cleaned) i "
        "left join cells c on c.student_id = s.student_id and c.content_item_name = i.content_item_name) d"
    )


@query(
    "matrix_summary",
    with_responses(
        f"{_cleaned_sql()}, {_LONG} " + " union all ".join(_summary_sql(v) for v in _VARIABLES)
    ),
)
def matrix_summary(spark, sf_dir):
    summary = matrix.matrix_summary(_long(_cleaned(spark, sf_dir)), _VARIABLES)
    return rounded(summary, "q1", "median", "mean", "q3")


TEMPLATES = (1, 2, 3, 4, 5)

# Combined matrices ------------------------------------------------------------------


def _exams(spark, sf_dir, templates):
    cleaned = _cleaned(spark, sf_dir, 1).where(F.col("template_id").isin(*templates))
    cleaned = dealt(cleaned, response_parts(spark, sf_dir), *matrix.CELL)
    exam = F.concat(F.lit("T"), F.col("template_id").cast("string"), F.lit("_"))
    return matrix.matrix_long(cleaned.withColumn("exam", exam), ["scored_response"], by=["exam"])


def _combined(exams, templates, id_column: str = "student_id", parts: int | None = None):
    items = {f"T{t}_": TENS for t in templates}
    return combine.combine_long(exams, "scored_response", items, ".", "-99", id_column, parts)


_EXAM_CELLS = (
    "cells as (select student_id, template_id, content_item_name, count(*) filter (attempted) as attempted, "
    f"{_strict('scored_response')} as scored_response from cleaned group by all), "
    f"coded as (select *, {_code('scored_response')} as code from cells)"
)


def _combined_sql(templates, source: str = "coded", id_column: str = "student_id") -> str:
    columns = ", ".join(
        f"case when count(*) filter (template_id = {t}) > 0 then nullif(coalesce("
        f"max(code) filter (template_id = {t} and content_item_name = '{u}'), '-99'), 'NA') end as \"T{t}_{u}\""
        for t in templates
        for u in TENS
    )
    listed = ", ".join(str(t) for t in templates)
    return f"select {id_column}, {columns} from {source} where template_id in ({listed}) group by {id_column}"


@query("combine_full", with_responses(f"{_cleaned_sql(1)}, {_EXAM_CELLS} {_combined_sql(TEMPLATES)}"))
def combine_full(spark, sf_dir):
    return _combined(_exams(spark, sf_dir, TEMPLATES), TEMPLATES, parts=response_parts(spark, sf_dir))


@query("combine_fold", with_responses(f"{_cleaned_sql(1)}, {_EXAM_CELLS} {_combined_sql(TEMPLATES)}"))
def combine_fold(spark, sf_dir):
    long = _exams(spark, sf_dir, TEMPLATES)
    exams = {f"T{t}_": long.where(F.col("exam") == f"T{t}_").drop("exam") for t in TEMPLATES}
    return combine.combine_wide(
        {p: matrix.matrix_wide(one, "scored_response", TENS, ".", "-99", response_parts(spark, sf_dir)) for p, one in exams.items()}
    )


@query("combine_stacked", with_responses(f"{_cleaned_sql(1)}, {_EXAM_CELLS} {_combined_sql(TEMPLATES)}"))
def combine_stacked(spark, sf_dir):
    long = _exams(spark, sf_dir, TEMPLATES)
    exams = {f"T{t}_": long.where(F.col("exam") == f"T{t}_").drop("exam") for t in TEMPLATES}
    return _combined(combine.stack_exams(exams), TEMPLATES, parts=response_parts(spark, sf_dir))


def _users(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("user_id"), F.col("c_custkey").cast("string").alias("student_id")
    )


def _first_source(spark, sf_dir, templates):
    """Exams of the source that knows students by their user id only."""
    users = _users(spark, sf_dir)
    exams = _exams(spark, sf_dir, templates).join(users, "student_id").drop("student_id")
    return combine.with_student_ids(_combined(exams, templates, "user_id", response_parts(spark, sf_dir)), users)


def _first_sql(templates) -> str:
    return (
        "select c.c_name as user_id, cast(c.c_custkey as varchar) as student_id, f.* exclude (student_id) from "
        f"({_combined_sql(templates)}) f join customer c on cast(c.c_custkey as varchar) = f.student_id"
    )


@query("combine_lookup", with_responses(f"{_cleaned_sql(1)}, {_EXAM_CELLS} {_first_sql(TEMPLATES)}"))
def combine_lookup(spark, sf_dir):
    return _first_source(spark, sf_dir, TEMPLATES)


@query(
    "combine_sources",
    with_responses(
        f"{_cleaned_sql(1)}, {_EXAM_CELLS}, a as ({_first_sql((1, 2))}), b as ({_combined_sql((3, 4, 5))}) "
        "select a.*, b.* exclude (student_id) from a join b on a.student_id = b.student_id"
    ),
)
def combine_sources(spark, sf_dir):
    users = _users(spark, sf_dir)
    first, second = ({f"T{t}_": TENS for t in templates} for templates in ((1, 2), (3, 4, 5)))
    # the first source knows students by their user id only
    named = _exams(spark, sf_dir, TEMPLATES).join(users, "student_id")
    own = F.when(F.col("exam").isin(*first), F.col("user_id")).otherwise(F.col("student_id"))
    long = named.withColumn("student_id", own).drop("user_id")
    return combine.combine_sources(long, "scored_response", first, second, users, ".", "-99", parts=response_parts(spark, sf_dir))


@query(
    "matrix_cells",
    with_responses(
        f"{_cleaned_sql()}, {_LONG} select student_id, content_item_name, least(attempted, 1) as attempted, "
        "case when attempted = 0 then 0 else scored_response end as scored_response from cells"
    ),
)
def matrix_cells(spark, sf_dir):
    """The matrix as text in blocks of columns, and back to one row per student and item."""
    cleaned = _cleaned(spark, sf_dir)
    # read for its items, its cells and its students
    long = stored(_long(cleaned))
    blocks = matrix.in_blocks(matrix.name_order(long), 700)
    lines = matrix.block_lines(long, "scored_response", blocks, ".", "-99", parts=response_parts(spark, sf_dir))
    text = lines.select("block", F.concat_ws(",", "student_id", "line").alias("value"))
    heads = matrix.block_headers(blocks).select("block", F.concat_ws(",", F.lit("student_id"), "line").alias("value"))
    found = cells.long_of_cells(cells.cells_of_lines(text, heads, ["block"], skip="-99"), "scored_response", ".", "-99")
    return found.select("student_id", "content_item_name", "attempted", "scored_response")
