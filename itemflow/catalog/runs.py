"""Whole cleaning runs and their audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from itemflow.catalog.registry import query, rounded
from itemflow.catalog.scores import ratio_sql, tallies_sql
from itemflow.catalog.tables import (
    CONTENT_SQL,
    SECTIONS_SQL,
    bank_map,
    content_items,
    responses,
    section_map,
    table,
    test_map,
    test_map_sql,
    with_responses,
)
from itemflow.plans.clean import CleanConfig, CleanInputs, clean
from itemflow.plans.steps import prepare

_ACTIVITY = "(partition by activity_id_hist)"
_SECTION = "(partition by activity_id_hist, section_name)"
_STUDENT = "(partition by student_id)"


class _Steps:
    """SQL of a run as a chain of named steps, each a table of its own."""

    def __init__(self) -> None:
        self.tables: list[tuple[str, str]] = []
        self.audited: list[tuple[str, str]] = []
        self.add("select * from responses", "start")

    @property
    def last(self) -> str:
        return self.tables[-1][0]

    def add(self, sql: str, step: str | None = None) -> _Steps:
        name = f"s{len(self.tables)}"
        self.tables.append((name, sql.format(t=self.tables[-1][0] if self.tables else "")))
        if step:
            self.audited.append((step, name))
        return self

    def keep(self, step: str, condition: str) -> _Steps:
        return self.add(f"select * from {{t}} where {condition}", step)

    def drop_activities(self, step: str, condition: str) -> _Steps:
        return self.add(
            "select * from {t} where activity_id_hist not in "
            f"(select activity_id_hist from {{t}} where {condition})",
            step,
        )

    def omit(self, condition: str, step: str) -> _Steps:
        return self.add(
            "select * replace (case when hit then 0 else raw_response end as raw_response, "
            "case when hit then 0 else scored_response end as scored_response, "
            "attempted and not hit as attempted) "
            f"from (select *, coalesce({condition}, false) as hit from (select * exclude (hit) from {{t}}) x) y",
            step,
        )

    def sql(self, final: str, **changed: str) -> str:
        chain = ", ".join(f"{name} as materialized ({sql})" for name, sql in self.tables)
        return with_responses(f"with {chain} {final.format(t=self.last)}", **changed)


def _row_steps(total_minutes: int | None = 1440, start: str | None = None) -> _Steps:
    steps = _Steps()
    if start:
        steps.add(f"select r.*, s.* exclude (section_name) from {{t}} r join {start} s "
                  "on r.section_name = s.section_name", "section_filter")
    steps.keep("no_enrollment", "enrollment_id is not null")
    steps.keep("incomplete", "activity_status in ('4', 'completed', 'Complete')")
    steps.keep("tutor", "tutor_mode <> 'True' or tutor_mode is null")
    if total_minutes is not None:
        steps.keep(
            "over_total_minutes",
            "date_diff('microsecond', timestamp_created, timestamp_completed) / 60000000.0 "
            f"<= {total_minutes}",
        )
    return steps


def _map_steps(steps: _Steps, num_ques: int | None) -> _Steps:
    return steps.add(
        "select r.*, m.num_ques as test_num_ques, m.minutes_allowed as test_minutes_allowed, "
        "m.response_threshold as test_response_threshold "
        f"from {{t}} r join {test_map_sql(num_ques)} m on r.template_name = m.template_name",
        "not_in_map",
    )


def _activity_steps(
    steps: _Steps, part: str = "template_name", allowed: str | None = "test_num_ques", repeats: bool = False
) -> _Steps:
    steps.add(
        f"select *, count(*) over (partition by activity_id_hist, {part}) as actual_num_ques from {{t}}"
    )
    steps.drop_activities("scored_without_response", "scored_response = 1 and raw_response is null")
    steps.drop_activities("negative_time", "milliseconds_used < 0")
    if allowed:
        steps.drop_activities("too_many_questions", f"actual_num_ques > {allowed}")
    steps.add(
        "select * from {t} where activity_id_hist not in (select activity_id_hist from {t} "
        "where content_item_id <> -1 group by activity_id_hist, content_item_name having count(*) > 1)",
        "duplicate_items",
    )
    if repeats:
        steps.add(
            "select * from {t} where activity_id_hist not in (select activity_id_hist from "
            "(select activity_id_hist, row_number() over (partition by student_id, template_name "
            "order by timestamp_created, activity_id_hist) as sitting from (select distinct student_id, "
            "template_name, activity_id_hist, timestamp_created from {t}) a) b where sitting > 1)",
            "repeat_administration",
        )
    return steps


def _item_steps(steps: _Steps) -> _Steps:
    steps.add(
        "select *, coalesce(raw_response <> 0, false) as attempted, raw_response as orig_response, "
        "scored_response as orig_score, false as hit from {t} where content_item_id <> -1",
        "staged",
    )
    return steps


def _repeat_steps(steps: _Steps) -> _Steps:
    steps.add(
        "select *, row_number() over (partition by content_item_id, student_id "
        "order by timestamp_created, response_id) > 1 as repeat_omitted from {t}"
    )
    return steps.omit("repeat_omitted", "repeat")


def _golden_steps() -> _Steps:
    steps = _map_steps(_row_steps(), 8)
    _repeat_steps(_item_steps(_activity_steps(steps, repeats=True)))
    steps.omit("milliseconds_used <= 5000", "timing_min").omit("milliseconds_used > 45000", "timing_max")
    steps.add(f"select *, {tallies_sql('template', _ACTIVITY)} from {{t}}")
    return steps.keep(
        "below_threshold",
        "cast(template_num_attempted as double) / nullif(test_num_ques, 0) >= test_response_threshold",
    )


_RUN = (
    "select response_id, student_id, activity_id_hist, raw_response, scored_response, attempted, "
    "orig_response, orig_score, repeat_omitted, actual_num_ques, "
)
RUN_COLUMNS = [
    "response_id", "student_id", "activity_id_hist", "raw_response", "scored_response", "attempted",
    "orig_response", "orig_score", "repeat_omitted", "actual_num_ques",
]
_TEMPLATE = "template_raw_correct, template_num_attempted, "
TEMPLATE_COLUMNS = ["template_raw_correct", "template_num_attempted", "template_pTotal", "template_pPlus"]


def _rates_sql(prefix: str, whole: str) -> str:
    return (
        ratio_sql(f"{prefix}_raw_correct", whole, f"{prefix}_pTotal") + ", "
        + ratio_sql(f"{prefix}_raw_correct", f"{prefix}_num_attempted", f"{prefix}_pPlus")
    )


GOLDEN = CleanConfig(
    total_minutes=1440, remove_repeat_administrations=True, ms_min=5000, ms_max=45000
)


def golden(spark, sf_dir, audit: bool = False):
    inputs = CleanInputs(test_map=test_map(spark, sf_dir))
    return clean(responses(spark, sf_dir), GOLDEN, inputs, audit=audit)


_GOLDEN_FINAL = (
    _RUN + _TEMPLATE + "template_num_omitted, "
    + ratio_sql("template_num_attempted", "test_num_ques", "template_perc_attempted") + ", "
    + _rates_sql("template", "test_num_ques") + " from {t}"
)


def golden_sql(**changed: str) -> str:
    return _golden_steps().sql(_GOLDEN_FINAL, **changed)


def golden_columns(cleaned):
    ratios = ["template_perc_attempted", "template_pTotal", "template_pPlus"]
    return rounded(cleaned, *ratios).select(
        *RUN_COLUMNS, *TEMPLATE_COLUMNS, "template_num_omitted", "template_perc_attempted"
    )


@query("clean_test_map", golden_sql())
def clean_test_map(spark, sf_dir):
    return golden_columns(golden(spark, sf_dir).cleaned)


def _flagship_steps() -> _Steps:
    steps = _activity_steps(_map_steps(_row_steps(None), 8))
    _item_steps(steps)
    steps.add(f"select *, {tallies_sql('template', _ACTIVITY)} from {{t}}")
    return steps.keep(
        "below_threshold",
        "cast(template_num_attempted as double) / nullif(test_num_ques, 0) >= test_response_threshold",
    )


@query(
    "flagship_activity_scores",
    _flagship_steps().sql(
        "select distinct student_id, activity_id_hist, template_name, template_raw_correct, "
        "template_num_attempted, template_num_omitted, " + _rates_sql("template", "test_num_ques")
        + " from {t}"
    ),
)
def flagship_activity_scores(spark, sf_dir):
    inputs = CleanInputs(test_map=test_map(spark, sf_dir))
    result = clean(responses(spark, sf_dir), CleanConfig(repeat_treatment="ignore"), inputs)
    return (
        rounded(result.cleaned, "template_pTotal", "template_pPlus")
        .select(
            "student_id", "activity_id_hist", "template_name", "template_num_omitted", *TEMPLATE_COLUMNS
        )
        .distinct()
    )


def _over_time_steps() -> _Steps:
    steps = _map_steps(_row_steps(), 8)
    steps.drop_activities("scored_without_response", "scored_response = 1 and raw_response is null")
    steps.drop_activities("negative_time", "milliseconds_used < 0")
    steps.add(
        "select * from {t} where activity_id_hist not in (select activity_id_hist from {t} "
        "group by activity_id_hist having sum(milliseconds_used) / 60000.0 > 2.0)",
        "over_time",
    )
    _repeat_steps(_item_steps(_activity_steps(steps)))
    steps.add(f"select *, {tallies_sql('template', _ACTIVITY)} from {{t}}")
    return steps.keep(
        "below_threshold",
        "cast(template_num_attempted as double) / nullif(test_num_ques, 0) >= test_response_threshold",
    )


@query(
    "clean_over_time",
    _over_time_steps().sql("select response_id, activity_id_hist, attempted, repeat_omitted from {t}"),
)
def clean_over_time(spark, sf_dir):
    config = CleanConfig(total_minutes=1440, remove_over_time=True)
    inputs = CleanInputs(test_map=test_map(spark, sf_dir, minutes=2.0))
    cleaned = clean(responses(spark, sf_dir), config, inputs).cleaned
    return cleaned.select("response_id", "activity_id_hist", "attempted", "repeat_omitted")


# Sections -------------------------------------------------------------------------


def _section_tallies(steps: _Steps) -> _Steps:
    return steps.add(
        f"select *, {tallies_sql('overall', _STUDENT)}, {tallies_sql('template', _ACTIVITY)}, "
        f"{tallies_sql('section', _SECTION)}, cast(sum(is_scored) over {_SECTION} as bigint) "
        "as section_num_scored from {t}"
    )


_SECTION_SQL = (
    "section_raw_correct, section_num_attempted, section_num_omitted, section_num_scored, "
    "overall_raw_correct, overall_num_attempted, "
    + ratio_sql("section_num_attempted", "section_num_ques", "section_perc_attempted") + ", "
    + _rates_sql("section", "section_num_ques") + ", "
)
SECTION_RATIOS = [
    "section_perc_attempted", "section_pTotal", "section_pPlus", "template_pTotal", "template_pPlus",
    "overall_pTotal", "overall_pPlus",
]
SECTION_COLUMNS = [
    "section_raw_correct", "section_num_attempted", "section_num_omitted", "section_num_scored",
    "overall_raw_correct", "overall_num_attempted", "template_raw_correct", "template_num_attempted",
    *SECTION_RATIOS,
]


def _section_steps(with_test_map: bool, low: str) -> _Steps:
    steps = _row_steps(1440, SECTIONS_SQL)
    if with_test_map:
        _activity_steps(_map_steps(steps, None))
    else:
        steps.add(
            f"select *, (select sum(section_num_ques) from {SECTIONS_SQL} m) as test_num_ques from {{t}}"
        )
        _activity_steps(steps, "section_name", "section_num_ques")
    _repeat_steps(_item_steps(steps))
    _section_tallies(steps)
    steps.add(
        "select t.*, taken.n as num_activities from {t} t join (select student_id, "
        "count(distinct activity_id_hist) as n from {t} group by student_id) taken "
        "on t.student_id = taken.student_id"
    )
    return steps.drop_activities("below_threshold", low)


def _section_sql(steps: _Steps, questions: str, **changed: str) -> str:
    return steps.sql(
        _RUN + _TEMPLATE + _SECTION_SQL + _rates_sql("template", "test_num_ques") + ", "
        + _rates_sql("overall", f"(num_activities * {questions})") + " from {t}",
        **changed,
    )


_SECTION_TOTAL = f"(select sum(section_num_ques) from {SECTIONS_SQL} m)"
_TEST_TOTAL = f"(select sum(num_ques) from {test_map_sql(None)} m)"


def section_columns(cleaned):
    return rounded(cleaned, *SECTION_RATIOS).select(*RUN_COLUMNS, *SECTION_COLUMNS)


def _section_run(spark, sf_dir, config, inputs):
    return section_columns(clean(responses(spark, sf_dir), config, inputs).cleaned)


def section_sql(**changed: str) -> str:
    low = "section_num_attempted < min_items_per_seq or template_num_attempted < 3"
    return _section_sql(_section_steps(True, low), _SECTION_TOTAL, **changed)


@query("clean_section_map", section_sql())
def clean_section_map(spark, sf_dir):
    config = CleanConfig(total_minutes=1440, section_separated=True)
    inputs = CleanInputs(test_map=test_map(spark, sf_dir, None), section_map=section_map(spark, sf_dir))
    return _section_run(spark, sf_dir, config, inputs)


@query(
    "clean_section_map_only",
    _section_sql(
        _section_steps(
            False, "cast(section_num_attempted as double) / section_num_ques < section_response_threshold"
        ),
        _SECTION_TOTAL,
    ),
)
def clean_section_map_only(spark, sf_dir):
    inputs = CleanInputs(section_map=section_map(spark, sf_dir, min_items=False))
    return _section_run(spark, sf_dir, CleanConfig(total_minutes=1440), inputs)


@query(
    "clean_section_by_test_threshold",
    _section_sql(
        _section_steps(
            True, "cast(section_num_attempted as double) / section_num_ques < test_response_threshold"
        ),
        _TEST_TOTAL,
    ),
)
def clean_section_by_test_threshold(spark, sf_dir):
    config = CleanConfig(total_minutes=1440, section_calc=False)
    sections = section_map(spark, sf_dir, min_items=False)
    inputs = CleanInputs(test_map=test_map(spark, sf_dir, None), section_map=sections)
    return _section_run(spark, sf_dir, config, inputs)


# Question banks ---------------------------------------------------------------------


_ORDERED = (
    "select t.*, o.place as actual_activity_order from {t} t join (select student_id, activity_id_hist, "
    "timestamp_created, row_number() over (partition by student_id order by timestamp_created, "
    "activity_id_hist) as place from (select distinct student_id, activity_id_hist, timestamp_created "
    "from {t}) a) o on t.student_id = o.student_id and t.activity_id_hist = o.activity_id_hist "
    "and t.timestamp_created = o.timestamp_created"
)


def _bank_steps() -> _Steps:
    steps = _activity_steps(_row_steps(), allowed=None)
    _repeat_steps(_item_steps(steps))
    steps.add(f"select *, {tallies_sql('template', _ACTIVITY)} from {{t}}")
    steps.keep("below_threshold", "template_num_attempted >= 2")
    steps.add(
        f"select *, {tallies_sql('overall', _STUDENT)}, "
        "(select count(distinct content_item_name) from {t}) as pool from {t}"
    )
    return steps.add(_ORDERED)


BANK_COLUMNS = [
    *TEMPLATE_COLUMNS, "overall_raw_correct", "overall_num_attempted", "overall_pTotal", "overall_pPlus",
    "actual_activity_order",
]


def bank_sql(**changed: str) -> str:
    return _bank_steps().sql(
        _RUN + _TEMPLATE + "overall_raw_correct, overall_num_attempted, actual_activity_order, "
        + _rates_sql("template", "actual_num_ques") + ", " + _rates_sql("overall", "pool") + " from {t}",
        **changed,
    )


BANK = CleanConfig(question_bank=True, total_minutes=1440, min_items=2)


def bank_columns(cleaned):
    ratios = ["template_pTotal", "template_pPlus", "overall_pTotal", "overall_pPlus"]
    return rounded(cleaned, *ratios).select(*RUN_COLUMNS, *BANK_COLUMNS)


@query("clean_qbank", bank_sql())
def clean_qbank(spark, sf_dir):
    inputs = CleanInputs(test_map=bank_map(spark, sf_dir))
    wanted = [*RUN_COLUMNS, *BANK_COLUMNS]
    return bank_columns(clean(responses(spark, sf_dir), BANK, inputs, columns=wanted).cleaned)


def _bank_section_steps() -> _Steps:
    steps = _activity_steps(_row_steps(1440, SECTIONS_SQL), "section_name", None)
    _repeat_steps(_item_steps(steps))
    _section_tallies(steps)
    steps.add("select *, (select count(distinct content_item_name) from {t}) as pool from {t}")
    steps.keep("below_threshold", "template_num_attempted >= 2")
    return steps.add(_ORDERED)


@query(
    "clean_qbank_sections",
    _bank_section_steps().sql(
        _RUN + _TEMPLATE + _SECTION_SQL + "actual_activity_order, "
        + _rates_sql("template", "actual_num_ques") + ", " + _rates_sql("overall", "pool") + " from {t}"
    ),
)
def clean_qbank_sections(spark, sf_dir):
    inputs = CleanInputs(section_map=section_map(spark, sf_dir))
    wanted = [*RUN_COLUMNS, *SECTION_COLUMNS, "actual_activity_order"]
    cleaned = clean(responses(spark, sf_dir), BANK, inputs, columns=wanted).cleaned
    return rounded(cleaned, *SECTION_RATIOS).select(*wanted)


# Every option at once ---------------------------------------------------------------


def _all_options_steps() -> _Steps:
    steps = _row_steps()
    _activity_steps(_map_steps(steps, 8), repeats=True)
    steps.drop_activities(
        "manual_exclusion", "activity_id_hist in (select o_orderkey from orders where o_totalprice > 300000)"
    )
    _item_steps(steps)
    steps.keep("unscored", "is_scored = 1")
    steps.omit(
        "exists (select 1 from part k where p_partkey % 10 = 0 and p_partkey = x.content_item_id "
        "and x.timestamp_created < timestamp '1995-01-01' + to_days(cast(p_size * 40 as int)))",
        "version_cutoff",
    )
    steps.omit("content_item_id in (select p_partkey from part where p_size = 7)", "version_list")
    _repeat_steps(steps)
    steps.omit("milliseconds_used <= 5000", "timing_min")
    steps.omit(
        "exists (select 1 from part k where p_partkey = x.content_item_id and p_size % 3 + 1 = x.correct_answer)",
        "old_keys",
    )
    steps.add(
        f"select t.*, c.brand from {{t}} t join {CONTENT_SQL} c on t.content_item_id = c.content_item_id "
        "and t.content_item_name = c.content_item_name where c.interaction_type_id <> 5",
        "content_join",
    )
    steps.add(
        "select *, content_item_name in (select concat('item_', lpad(cast(p_partkey as varchar), 6, '0')) "
        f"from part where p_size > 40) as field_test, {tallies_sql('template', _ACTIVITY)} from {{t}}"
    )
    return steps.keep(
        "below_threshold",
        "cast(template_num_attempted as double) / nullif(test_num_ques, 0) >= test_response_threshold",
    )


def all_options(spark, sf_dir, audit: bool = False):
    parts, orders = table(spark, sf_dir, "part"), table(spark, sf_dir, "orders")
    item = F.col("p_partkey").alias("content_item_id")
    name = F.concat(F.lit("item_"), F.lpad(F.col("p_partkey").cast("string"), 6, "0"))
    since = F.lit("1995-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=F.col("p_size") * 40)
    inputs = CleanInputs(
        test_map=test_map(spark, sf_dir),
        manual_exclusion=orders.where("o_totalprice > 300000").select(
            F.col("o_orderkey").alias("activity_id_hist")
        ),
        version_cutoffs=parts.where("p_partkey % 10 = 0").select(item, since.alias("cutoff_date")),
        version_list=parts.where("p_size = 7").select(item),
        old_keys=parts.select(item, (F.col("p_size") % 3 + 1).alias("correct_answer")),
        field_test=parts.where("p_size > 40").select(name.alias("content_item_name")),
        content=content_items(spark, sf_dir),
    )
    config = CleanConfig(
        total_minutes=1440,
        remove_repeat_administrations=True,
        remove_unscored=True,
        ms_min=5000,
        extra_content=("brand",),
        interaction_types=tuple(t for t in range(12) if t != 5),
    )
    return clean(responses(spark, sf_dir), config, inputs, audit=audit)


@query(
    "clean_all_options",
    _all_options_steps().sql(
        _RUN + _TEMPLATE + "brand, field_test, " + _rates_sql("template", "test_num_ques") + " from {t}"
    ),
)
def clean_all_options(spark, sf_dir):
    cleaned = all_options(spark, sf_dir).cleaned
    return rounded(cleaned, "template_pTotal", "template_pPlus").select(
        *RUN_COLUMNS, *TEMPLATE_COLUMNS, "brand", "field_test"
    )


# Audit --------------------------------------------------------------------------------

LEFT = ["responses_left", "activities_left", "users_left", "items_left"]
REMOVED = ["responses_removed", "activities_removed", "users_removed", "items_removed"]
OMITTED = ["omitted_responses", "omitted_activities", "omitted_users"]


def _funnel_sql(steps: _Steps, **changed: str) -> str:
    each = " union all ".join(
        f"select {i} as step_no, '{step}' as step, count(*) as responses_left, "
        "count(distinct activity_id_hist) as activities_left, count(distinct student_id) as users_left, "
        f"count(distinct content_item_name) as items_left from {name}"
        for i, (step, name) in enumerate(steps.audited)
    )
    removed = ", ".join(
        f"coalesce(lag({left}) over (order by step_no) - {left}, 0) as {gone}"
        for left, gone in zip(LEFT, REMOVED)
    )
    return steps.sql(f"select *, {removed} from ({each}) f", **changed)


def _omitted_sql(steps: _Steps, shown: list[str]) -> str:
    return steps.sql(
        " union all ".join(
            f"select {i} as step_no, '{step}' as step, count(*) as omitted_responses, "
            "count(distinct activity_id_hist) as omitted_activities, "
            f"count(distinct student_id) as omitted_users from {name} where not attempted"
            for i, (step, name) in enumerate(steps.audited)
            if step in shown
        )
    )


def funnel_sql(**changed: str) -> str:
    return _funnel_sql(_golden_steps(), **changed)


@query("audit_funnel", funnel_sql())
def audit_funnel(spark, sf_dir):
    return golden(spark, sf_dir, audit=True).audit.select("step_no", "step", *LEFT, *REMOVED)


@query("audit_omits", _omitted_sql(_golden_steps(), ["staged", "repeat", "timing_min", "timing_max"]))
def audit_omits(spark, sf_dir):
    steps = golden(spark, sf_dir, audit=True).audit
    return steps.where("omitted_responses is not null").select("step_no", "step", *OMITTED)


@query("audit_all_options", _funnel_sql(_all_options_steps()))
def audit_all_options(spark, sf_dir):
    return all_options(spark, sf_dir, audit=True).audit.select("step_no", "step", *LEFT, *REMOVED)


@query(
    "run_marked_omits",
    (lambda s: _repeat_steps(s).sql("select response_id, raw_response, orig_response from {t} "
                                    "where raw_response <> orig_response"))(
        _item_steps(_activity_steps(_map_steps(_row_steps(), 8)))
    ),
)
def run_marked_omits(spark, sf_dir):
    inputs = CleanInputs(test_map=test_map(spark, sf_dir))
    result = clean(responses(spark, sf_dir), CleanConfig(total_minutes=1440), inputs)
    return result.marked_omits.select("response_id", "raw_response", "orig_response")


@query(
    "run_removed_repeats",
    (lambda s: s.add("select *, row_number() over (partition by content_item_id, student_id "
                     "order by timestamp_created, response_id) as seen from {t}")
     .sql("select response_id, content_item_id from {t} where seen > 1"))(
        _item_steps(_activity_steps(_map_steps(_row_steps(), 8)))
    ),
)
def run_removed_repeats(spark, sf_dir):
    inputs = CleanInputs(test_map=test_map(spark, sf_dir))
    config = CleanConfig(total_minutes=1440, repeat_treatment="remove")
    result = clean(responses(spark, sf_dir), config, inputs)
    return result.removed_repeats.select("response_id", "content_item_id")


# A study's preparation, and runs on activities that students share ---------------------


def _prepare_steps() -> _Steps:
    steps = _Steps()
    steps.keep("not_in_activities", "student_id in (select cast(c_custkey as varchar) from customer where c_acctbal >= 0)")
    steps.keep(
        "repeat_enrollment",
        "enrollment_id is null or enrollment_id not in (select c_custkey from customer where c_mktsegment = 'BUILDING')",
    )
    steps.keep("zero_enrollment", "enrollment_id <> 0")
    steps.add(
        "select * from {t} r where not exists (select 1 from {t} d "
        "where (d.activity_status = 'reset' or regexp_matches(d.template_name, '[0-9]_d')) and d.student_id = r.student_id "
        "and d.enrollment_id = r.enrollment_id and d.template_id = r.template_id)",
        "deleted_template",
    )
    return steps.add(
        f"select r.* from {{t}} r where exists (select 1 from {CONTENT_SQL} c where c.content_item_id = r.content_item_id "
        "and c.content_item_name = r.content_item_name and c.template_id = r.template_id)",
        "not_in_content",
    )


@query("audit_prepare", _funnel_sql(_prepare_steps()))
def audit_prepare(spark, sf_dir):
    """Every response that is lost on the way to the cleaning, from the first join to the last."""
    source = responses(spark, sf_dir).withColumn("source_system", F.lit("A"))
    customers = table(spark, sf_dir, "customer")
    # the export of activities has those of students whose account is in credit
    known = customers.where("c_acctbal >= 0").select(F.col("c_custkey").cast("string").alias("student_id"))
    activities = source.join(known, "student_id").select("student_id", "activity_id", "source_system", "activity_status").distinct()
    again = customers.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("enrollment_id"))
    prepared = prepare(source.drop("activity_status"), activities, content_items(spark, sf_dir), again)
    return prepared.audit.select("step_no", "step", *LEFT, *REMOVED)


# the last response of an activity of two or more was given by somebody else
_TWIN_SQL = "case when item_section_position = 5 then concat('twin of ', student_id) else student_id end"


@query("clean_shared_activities", golden_sql(student_id=_TWIN_SQL))
def clean_shared_activities(spark, sf_dir):
    """Students with activities of their own, and students who share some."""
    twin = F.concat(F.lit("twin of "), F.col("student_id"))
    shared = F.when(F.col("item_section_position") == 5, twin).otherwise(F.col("student_id"))
    inputs = CleanInputs(test_map=test_map(spark, sf_dir))
    return golden_columns(clean(responses(spark, sf_dir, student_id=shared), GOLDEN, inputs).cleaned)
