"""Rules that turn responses into omitted ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from itemflow.catalog.registry import query, rounded
from itemflow.catalog.tables import responses, table, with_responses
from itemflow.operators import omissions, profile, rows

SHOWN = (
    "response_id", "raw_response", "scored_response", "attempted", "orig_response", "orig_score",
)


def _recoded(condition: str, more: str = "", source: str = "responses", **changed: str) -> str:
    """SQL of an omission: ``condition`` may be null, which means false."""
    return with_responses(
        f"with flagged as (select r.*, coalesce({condition}, false) as omit from {source} r) "
        "select response_id, case when omit then 0 else raw_response end as raw_response, "
        "case when omit then 0 else scored_response end as scored_response, "
        "case when omit then false else coalesce(raw_response <> 0, false) end as attempted, "
        f"raw_response as orig_response, scored_response as orig_score{more} from flagged",
        **changed,
    )


def _attempted(spark, sf_dir, **changed):
    return omissions.add_attempted(responses(spark, sf_dir, **changed))


@query("omit_base", _recoded("is_scored = 0 and raw_response > 1"))
def omit_base(spark, sf_dir):
    condition = (F.col("is_scored") == 0) & (F.col("raw_response") > 1)
    return omissions.recode_as_omitted(_attempted(spark, sf_dir), condition).select(*SHOWN)


# two cutoffs per listed item: the date the part's size gives, and one 200 days later
_CUTOFFS_SQL = (
    "(select content_item_name, content_item_id, cutoff_date from (select "
    "concat('item_', lpad(cast(p_partkey as varchar), 6, '0')) as content_item_name, "
    "p_partkey as content_item_id, timestamp '1995-01-01' + to_days(cast(p_size * 40 + d.extra as int)) as cutoff_date "
    "from part, (values (0), (200)) d(extra) where p_partkey % 10 = 0) c)"
)


def _cutoffs(spark, sf_dir, key: str):
    part = F.col("p_partkey")
    days = F.explode(F.array(F.lit(0), F.lit(200)))
    start = F.lit("1995-01-01").cast("timestamp_ntz")
    return (
        table(spark, sf_dir, "part")
        .where(part % 10 == 0)
        .withColumn("extra", days)
        .select(
            F.concat(F.lit("item_"), F.lpad(part.cast("string"), 6, "0")).alias("content_item_name"),
            part.alias("content_item_id"),
            (start + F.make_dt_interval(days=F.col("p_size") * 40 + F.col("extra"))).alias("cutoff_date"),
        )
        .select(key, "cutoff_date")
    )


def _any_cutoff(key: str, sign: str) -> str:
    return (
        f"exists (select 1 from {_CUTOFFS_SQL} k where k.{key} = r.{key} "
        f"and r.timestamp_created {sign} k.cutoff_date)"
    )


@query("version_cutoff_before", _recoded(_any_cutoff("content_item_name", "<")))
def version_cutoff_before(spark, sf_dir):
    cutoffs = _cutoffs(spark, sf_dir, "content_item_name")
    return omissions.omit_version_cutoffs(_attempted(spark, sf_dir), cutoffs).select(*SHOWN)


@query("version_cutoff_after", _recoded(_any_cutoff("content_item_name", ">")))
def version_cutoff_after(spark, sf_dir):
    cutoffs = _cutoffs(spark, sf_dir, "content_item_name")
    return omissions.omit_version_cutoffs(_attempted(spark, sf_dir), cutoffs, "after").select(*SHOWN)


@query("version_cutoff_by_id", _recoded(_any_cutoff("content_item_id", "<")))
def version_cutoff_by_id(spark, sf_dir):
    # by id the cutoff always counts before the date, whatever is asked for
    cutoffs = _cutoffs(spark, sf_dir, "content_item_id")
    return omissions.omit_version_cutoffs(_attempted(spark, sf_dir), cutoffs, "after").select(*SHOWN)


@query("version_list", _recoded("r.content_item_id in (select p_partkey from part where p_size = 7)"))
def version_list(spark, sf_dir):
    items = table(spark, sf_dir, "part").where("p_size = 7").select(F.col("p_partkey").alias("content_item_id"))
    return omissions.omit_version_list(_attempted(spark, sf_dir), items).select(*SHOWN)


_RANKED = (
    "(select *, case when timestamp_created is not null then row_number() over "
    "(partition by content_item_id, student_id, timestamp_created is null "
    "order by timestamp_created, response_id) end as seen from responses)"
)


@query("repeat_omit", _recoded("seen > 1", ", seen > 1 as repeat_omitted", source=_RANKED))
def repeat_omit(spark, sf_dir):
    kept, _ = omissions.repeat_questions(_attempted(spark, sf_dir))
    return kept.select(*SHOWN, "repeat_omitted")


@query("repeat_omit_spread", _recoded("seen > 1", ", seen > 1 as repeat_omitted", source=_RANKED))
def repeat_omit_spread(spark, sf_dir):
    """The same, for items that one student may be shown any number of times."""
    kept, _ = omissions.repeat_questions(_attempted(spark, sf_dir), spread=True)
    return kept.select(*SHOWN, "repeat_omitted")


@query(
    "repeat_remove",
    with_responses(f"select response_id, content_item_id, student_id from {_RANKED} r where seen = 1"),
)
def repeat_remove(spark, sf_dir):
    kept, _ = omissions.repeat_questions(_attempted(spark, sf_dir), "remove")
    return kept.select("response_id", "content_item_id", "student_id")


@query(
    "repeat_removed_rows",
    with_responses(f"select response_id, content_item_id, student_id from {_RANKED} r where seen > 1"),
)
def repeat_removed_rows(spark, sf_dir):
    _, removed = omissions.repeat_questions(_attempted(spark, sf_dir), "remove")
    return removed.select("response_id", "content_item_id", "student_id")


@query(
    "repeat_ignore",
    with_responses("select response_id, raw_response, false as repeat_omitted from responses"),
)
def repeat_ignore(spark, sf_dir):
    kept, _ = omissions.repeat_questions(_attempted(spark, sf_dir), "ignore")
    return kept.select("response_id", "raw_response", "repeat_omitted")


@query("timing_min", _recoded("milliseconds_used <= 5000"))
def timing_min(spark, sf_dir):
    return omissions.timing_exclusion(_attempted(spark, sf_dir), ms_min=5000).select(*SHOWN)


@query("timing_max", _recoded("milliseconds_used > 45000"))
def timing_max(spark, sf_dir):
    return omissions.timing_exclusion(_attempted(spark, sf_dir), ms_max=45000).select(*SHOWN)


@query("timing_seconds", _recoded("milliseconds_used / 1000.0 <= 5 or milliseconds_used / 1000.0 > 45"))
def timing_seconds(spark, sf_dir):
    frame = _attempted(spark, sf_dir).withColumn("seconds_used", F.col("milliseconds_used") / 1000)
    frame = frame.drop("milliseconds_used")
    return omissions.timing_exclusion(frame, sec_min=5, sec_max=45).select(*SHOWN)


@query(
    "old_keys",
    _recoded(
        "exists (select 1 from part k where k.p_partkey = r.content_item_id "
        "and k.p_size % 3 + 1 = r.correct_answer)"
    ),
)
def old_keys(spark, sf_dir):
    listed = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("content_item_id"), (F.col("p_size") % 3 + 1).alias("correct_answer")
    )
    return omissions.omit_old_keys(_attempted(spark, sf_dir), listed).select(*SHOWN)


@query(
    "letter_recode",
    with_responses(
        "select response_id, letter as rawest_response, "
        "cast(case letter when 'A' then 1 when 'B' then 2 when 'C' then 3 when 'D' then 4 end as bigint) "
        "as raw_response, letter is not null and letter in ('A', 'B', 'C', 'D') as attempted "
        "from (select *, substr('EABCD', cast(raw_response + 1 as int), 1) as letter from responses) r"
    ),
)
def letter_recode(spark, sf_dir):
    letter = F.substr(F.lit("EABCD"), (F.col("raw_response") + 1).cast("int"), F.lit(1))
    recoded = omissions.recode_letters(responses(spark, sf_dir, raw_response=letter))
    return omissions.add_attempted(recoded).select(
        "response_id", "rawest_response", "raw_response", "attempted"
    )


@query(
    "zero_repeats",
    with_responses(
        "select response_id, milliseconds_used * case when seen > 1 then 0 else 1 end "
        f"as milliseconds_used_fixed from {_RANKED} r"
    ),
)
def zero_repeats(spark, sf_dir):
    kept, _ = omissions.repeat_questions(_attempted(spark, sf_dir))
    return omissions.zero_repeats(kept, ["milliseconds_used"]).select(
        "response_id", "milliseconds_used_fixed"
    )


@query(
    "field_test_flag",
    with_responses(
        "select response_id, content_item_name, content_item_name in "
        "(select concat('item_', lpad(cast(p_partkey as varchar), 6, '0')) from part where p_size > 40) "
        "as field_test from responses"
    ),
)
def field_test_flag(spark, sf_dir):
    trial = table(spark, sf_dir, "part").where("p_size > 40").select(
        F.concat(F.lit("item_"), F.lpad(F.col("p_partkey").cast("string"), 6, "0")).alias("content_item_name")
    )
    flagged = omissions.flag_field_test(responses(spark, sf_dir), trial)
    return flagged.select("response_id", "content_item_name", "field_test")


@query(
    "marked_omits",
    with_responses(
        "select response_id, 0::bigint as raw_response, raw_response as orig_response "
        f"from {_RANKED} r where (seen > 1 or {_any_cutoff('content_item_name', '<')}) and raw_response <> 0"
    ),
)
def marked_omits(spark, sf_dir):
    cutoffs = _cutoffs(spark, sf_dir, "content_item_name")
    frame = omissions.omit_version_cutoffs(_attempted(spark, sf_dir), cutoffs)
    kept, _ = omissions.repeat_questions(frame)
    return omissions.marked_omits(kept).select("response_id", "raw_response", "orig_response")


@query(
    "timing_profile",
    with_responses(
        "select count(milliseconds_used) as n_values, cast(min(milliseconds_used) as double) as minimum, "
        "round(quantile_cont(milliseconds_used, 0.25), 6) as q1, "
        "round(quantile_cont(milliseconds_used, 0.5), 6) as median, "
        "round(avg(milliseconds_used), 6) as mean, round(quantile_cont(milliseconds_used, 0.75), 6) as q3, "
        "cast(max(milliseconds_used) as double) as maximum, "
        "count(*) filter (milliseconds_used <= 0) as n_not_positive from responses where raw_response <> 0"
    ),
)
def timing_profile(spark, sf_dir):
    summary = profile.timing_profile(responses(spark, sf_dir))
    return rounded(summary, "q1", "median", "mean", "q3")


@query(
    "timing_effect",
    with_responses("select count(*) as n_changed from responses where milliseconds_used <= 5000"),
)
def timing_effect(spark, sf_dir):
    return profile.timing_effect(responses(spark, sf_dir), 5000)


@query(
    "answered_responses",
    with_responses("select response_id, raw_response from responses where raw_response <> 0"),
)
def answered_responses(spark, sf_dir):
    return rows.answered(responses(spark, sf_dir)).select("response_id", "raw_response")
