"""The cleaning run: rules, omissions, scores and thresholds as one lazy plan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemflow.functions.checkpoints import checkpointed, stored
from itemflow.functions.columns import (
    any_where,
    count_where,
    milliseconds_to_minutes,
    only,
    plain,
    strict_sum,
)
from itemflow.operators import exclusions, omissions, rows, scoring
from itemflow.operators.audit import COUNTED, DROP_STEP, OMIT_STEP, funnel
from itemflow.operators.joins import equi_join, flag_members
from itemflow.plans.layout import HOT_ROWS, Branch, branches

_MARK = "__"
BELOW = "__below"


@dataclass(frozen=True)
class CleanConfig:
    """Options of a cleaning run; the defaults are those of a plain test."""

    question_bank: bool = False
    remove_no_enrollment: bool = True
    remove_incomplete: bool = True
    remove_tutor: bool = True
    total_minutes: float | None = None
    remove_no_response_scored: bool = True
    no_response: str = "null"
    remove_over_time: bool = False
    remove_repeat_administrations: bool = False
    recode_answers: bool = False
    remove_unscored: bool = False
    repeat_treatment: str = "omit"
    version_before_after: str = "before"
    ms_min: float | None = None
    ms_max: float | None = None
    sec_min: float | None = None
    sec_max: float | None = None
    min_items: int | None = None
    section_calc: bool = True
    section_separated: bool = False
    extra_content: tuple[str, ...] = ()
    interaction_types: tuple[int, ...] = (1,)
    layout: str = "auto"
    hot_rows: int = HOT_ROWS


@dataclass(frozen=True)
class CleanInputs:
    """The small tables that steer a run. All but one of the maps are optional."""

    test_map: DataFrame | None = None
    section_map: DataFrame | None = None
    manual_exclusion: DataFrame | None = None
    version_cutoffs: DataFrame | None = None
    version_list: DataFrame | None = None
    old_keys: DataFrame | None = None
    field_test: DataFrame | None = None
    content: DataFrame | None = None


@dataclass(frozen=True)
class CleanResult:
    cleaned: DataFrame
    sections: list[str] = field(default_factory=list)
    marked_omits: DataFrame | None = None
    removed_repeats: DataFrame | None = None
    audit: DataFrame | None = None

    def by_section(self) -> dict[str, DataFrame]:
        """One frame per section of the map, or everything as ``cleaned_data``."""
        if not self.sections:
            return {"cleaned_data": self.cleaned}
        return {s: self.cleaned.where(F.col("section_name") == s) for s in self.sections}


@dataclass
class _Run:
    """Rows on their way through the rules.

    Without an audit a rule filters, so that its condition reaches the scan. With
    one, rows keep the number of the first rule that removes them, and everything
    that follows looks only at the rows still alive.
    """

    frame: DataFrame
    tagged: bool
    steps: list[str]
    omit_steps: list[str]
    branch: Branch | None = None

    @property
    def alive(self) -> Column | None:
        return F.col(DROP_STEP).isNull() if self.tagged else None

    def living(self) -> DataFrame:
        return self.frame.where(self.alive) if self.tagged else self.frame

    def number(self, step: str) -> int:
        if step not in self.steps:
            self.steps.append(step)
        return self.steps.index(step)

    def keep(self, step: str, condition: Column) -> None:
        """Keep rows on which the condition holds; null does not hold."""
        number = self.number(step)
        if self.tagged:
            gone = F.coalesce(~condition, F.lit(True))
            self._tag(DROP_STEP, gone, number)
        else:
            self.frame = self.frame.where(condition)

    def drop(self, step: str, condition: Column) -> None:
        """Drop rows on which the condition holds; null does not hold."""
        self.keep(step, F.coalesce(~condition, F.lit(True)))

    def omit(self, step: str, condition: Column) -> None:
        number = self.number(step)
        if step not in self.omit_steps:
            self.omit_steps.append(step)
        if self.tagged:
            self._tag(OMIT_STEP, F.coalesce(condition, F.lit(False)) & F.col("attempted"), number)
        self.frame = omissions.recode_as_omitted(self.frame, condition)

    def _tag(self, column: str, condition: Column, number: int) -> None:
        free = F.col(column).isNull() & F.col(DROP_STEP).isNull()
        self.frame = self.frame.withColumn(
            column, F.when(free & condition, F.lit(number)).otherwise(F.col(column))
        )

    def attach(self, keys, aggregates) -> None:
        self.frame = self.branch.attach(self.frame, keys, aggregates)

    def join_map(self, step: str, table: DataFrame, key: str) -> None:
        """Attach a map's columns and drop the rows it does not know."""
        number = self.number(step)
        if not self.tagged:
            self.frame = equi_join(self.frame, F.broadcast(table), [key], "inner")
            return
        table = table.withColumn("__in_map", F.lit(True))
        self.frame = equi_join(self.frame, F.broadcast(table), [key], "left")
        self._tag(DROP_STEP, F.col("__in_map").isNull(), number)
        self.frame = self.frame.drop("__in_map")


def clean(
    responses: DataFrame,
    config: CleanConfig = CleanConfig(),
    inputs: CleanInputs = CleanInputs(),
    audit: bool = False,
    save_to: str | None = None,
    columns: Sequence[str] = (),
) -> CleanResult:
    """Clean and score responses.

    With ``audit`` the result also tells what each step removed. ``save_to``
    names a folder in shared storage: the rows are written there once and the
    frames of the result read them back, instead of each running the plan.
    ``columns`` are those of the cleaned rows that are wanted, all if none is named: what
    nobody reads is then not sorted, dealt and stored on the way of a question bank.
    """
    if inputs.test_map is None and inputs.section_map is None:
        raise ValueError("a test map or a section map is needed")
    if responses is None:
        raise ValueError("no responses given")
    config_treatment = omissions.check_treatment(config.repeat_treatment)

    run = _Run(responses, audit, ["start"], [])
    if audit:
        run.frame = run.frame.withColumns(
            {DROP_STEP: F.lit(None).cast("int"), OMIT_STEP: F.lit(None).cast("int")}
        )
    _row_rules(run, config, inputs)
    _flag_lists(run, config, inputs)

    scored, marked, removed = [], [], []
    for branch in branches(responses, run.frame, config.layout, config.hot_rows):
        part = _Run(branch.rows, audit, run.steps, run.omit_steps, branch)
        _activity_rules(part, config, inputs)
        _item_rules(part, config)
        removed.append(_omissions(part, config, config_treatment, marked))
        _content(part, config, inputs)
        _scores(part, config, inputs)
        scored.append(_finished(part.frame, inner=True))

    frame = _union(scored)
    if save_to is not None:
        frame.write.mode("overwrite").parquet(save_to)
        frame = frame.sparkSession.read.parquet(save_to)
    elif config.question_bank:
        # the items of the bank are counted over the scored rows: these are made once
        if columns:
            kept = {*columns, *scoring.STUDENT_TALLIES, *COUNTED.values(), DROP_STEP, OMIT_STEP, BELOW}
            frame = frame.select(*[c for c in frame.columns if c in kept])
        frame = stored(frame)
    table = funnel(frame, run.steps, run.omit_steps) if audit else None
    cleaned = frame.where(F.col(DROP_STEP).isNull()) if audit else frame
    if config.question_bank:
        pool = cleaned
        if _has_sections(config, inputs) and config.min_items is not None:
            # the bank holds the items of activities below the minimum as well
            if audit:
                late = run.steps.index("below_threshold")
                pool = frame.where(F.col(DROP_STEP).isNull() | (F.col(DROP_STEP) == late))
            else:
                cleaned = frame.where(~F.col(BELOW))
        cleaned = scoring.student_rates(cleaned, scoring.distinct_items(pool))
    cleaned = cleaned.select(*columns) if columns else _finished(cleaned)
    return CleanResult(
        cleaned=cleaned,
        sections=_section_names(config, inputs),
        marked_omits=_union(marked) if marked else None,
        removed_repeats=_union(removed) if config_treatment == "remove" else None,
        audit=table,
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _finished(frame: DataFrame, inner: bool = False) -> DataFrame:
    """The frame without helper columns, with or without those that the end of the run needs."""
    kept = (DROP_STEP, OMIT_STEP, BELOW) if inner else ()
    return frame.drop(*[c for c in frame.columns if c.startswith(_MARK) and c not in kept])


def _has_sections(config: CleanConfig, inputs: CleanInputs) -> bool:
    return inputs.section_map is not None or config.section_separated


def _section_names(config: CleanConfig, inputs: CleanInputs) -> list[str]:
    if inputs.section_map is None or not (config.section_separated or config.question_bank):
        return []
    return [r.section_name for r in inputs.section_map.select("section_name").distinct().collect()]


def _total(table: DataFrame, column: str):
    return table.agg(F.sum(column)).first()[0]


# Rules on single rows: no shuffle --------------------------------------------


def _section_columns(config: CleanConfig, inputs: CleanInputs) -> DataFrame:
    table = inputs.section_map
    columns = ["section_name", "section_num_ques"]
    if config.question_bank:
        if inputs.test_map is None:
            columns += [
                F.col("minutes_allowed").alias("test_minutes_allowed"),
                F.col("response_threshold").alias("test_response_threshold"),
            ]
    else:
        columns += [
            c for c in ("section_response_threshold", "min_items_per_seq") if c in table.columns
        ]
        if inputs.test_map is None and "minutes_allowed" in table.columns:
            columns.append(F.col("minutes_allowed").alias("test_minutes_allowed"))
    return table.select(*columns)


def _row_rules(run: _Run, config: CleanConfig, inputs: CleanInputs) -> None:
    if inputs.section_map is not None:
        run.join_map("section_filter", _section_columns(config, inputs), "section_name")
    if config.remove_no_enrollment:
        run.keep("no_enrollment", rows.has_enrollment())
    if config.remove_incomplete:
        run.keep("incomplete", rows.is_complete())
    if config.remove_tutor:
        run.keep("tutor", rows.is_not_tutor())
    if config.total_minutes is not None:
        run.frame = run.frame.withColumn("total_time", rows.total_time())
        run.keep("over_total_minutes", F.col("total_time") <= config.total_minutes)
    if inputs.test_map is None:
        if not config.question_bank:
            expected = _total(inputs.section_map, "section_num_ques")
            run.frame = run.frame.withColumn("test_num_ques", F.lit(expected))
    elif config.question_bank:
        run.frame = rows.join_question_bank_map(run.frame, inputs.test_map)
    else:
        run.join_map("not_in_map", rows.test_columns(inputs.test_map), "template_name")


def _flag_lists(run: _Run, config: CleanConfig, inputs: CleanInputs) -> None:
    """Look rows up in the lists while no partitioning has to be kept."""
    if inputs.manual_exclusion is not None:
        run.frame = flag_members(run.frame, inputs.manual_exclusion, exclusions.ACTIVITY, "__manual")
    if inputs.version_cutoffs is not None:
        run.frame = omissions.flag_version_cutoffs(
            run.frame, inputs.version_cutoffs, "__cutoff_old", config.version_before_after
        )
    if inputs.version_list is not None:
        run.frame = omissions.flag_version_list(run.frame, inputs.version_list, "__listed_old")
    if inputs.old_keys is not None:
        run.frame = omissions.flag_old_keys(run.frame, inputs.old_keys, "__old_key")
    if inputs.field_test is not None:
        run.frame = omissions.flag_field_test(run.frame, inputs.field_test)


# Rules on activities -----------------------------------------------------------


def _activity_rules(run: _Run, config: CleanConfig, inputs: CleanInputs) -> None:
    activity = list(run.branch.activity)
    by_section = inputs.test_map is None
    part = "section_name" if by_section else "template_name"
    allowed = "section_num_ques" if by_section else "test_num_ques"

    conditions = {"negative_time": exclusions.negative_time()}
    if config.remove_no_response_scored:
        conditions = {"scored_without_response": exclusions.scored_without_response(config.no_response)} | conditions
    place = "section_name" if inputs.section_map is not None else None
    judge = _judged_together if run.branch.apart else _judged_by_window
    bad = judge(run, conditions, part, None if config.question_bank else allowed, place, config.remove_over_time)
    for step in bad:
        run.drop(step, F.col(f"__{step}"))

    if config.remove_repeat_administrations and run.branch.apart:
        # met where the rows were dealt for the rules above
        run.frame = equi_join(run.frame, _later_sittings(run), activity, "left")
        run.drop("repeat_administration", F.col("__later"))
    elif config.remove_repeat_administrations:
        first = plain(F.min(only(exclusions.sitting(), run.alive)))
        run.attach(["student_id", "template_name"], {"__first_sitting": first})
        later = exclusions.is_later_sitting(F.col("__first_sitting"))
        run.attach(activity, {"__later": any_where(later, run.alive)})
        run.drop("repeat_administration", F.col("__later"))
    if inputs.manual_exclusion is not None:
        run.drop("manual_exclusion", F.col("__manual"))


def _judged_by_window(
    run: _Run, conditions: dict[str, Column], part: str, allowed: str | None, place: str | None, over_time: bool
) -> list[str]:
    """Attach ``actual_num_ques`` and a flag for each rule that an activity can break; returns the rules."""
    activity = list(run.branch.activity)
    run.frame = scoring.question_counts(run.frame, part, run.branch.attach, activity, run.alive)
    bad = dict(conditions)
    if over_time:
        used = strict_sum(F.col("milliseconds_used"), run.alive)
        run.attach([*activity, *([place] if place else [])], {"__time_used": used})
        bad["over_time"] = milliseconds_to_minutes(F.col("__time_used")) > F.col("test_minutes_allowed")
    if allowed:
        bad["too_many_questions"] = F.col("actual_num_ques") > F.col(allowed)
    run.attach([*activity, "content_item_name"], {"__shown": count_where(rows.is_not_staged(), run.alive)})
    bad["duplicate_items"] = F.col("__shown") > 1
    # these rules look at nothing but the activity itself, so they can be found together
    run.attach(activity, {f"__{step}": any_where(c, run.alive) for step, c in bad.items()})
    return list(bad)


def _judged_together(
    run: _Run, conditions: dict[str, Column], part: str, allowed: str | None, place: str | None, over_time: bool
) -> list[str]:
    """The same flags from one aggregate of the rows, saved once.

    A row counts for its part of the activity, for its item, and for its share of the
    time; each of these groups is added up before the shuffle. One verdict per activity is
    made of the saved groups and joined to the rows.
    """
    activity, alive = list(run.branch.activity), F.lit(True) if run.alive is None else run.alive
    living = F.coalesce(alive, F.lit(False))

    def entry(kind: str, key: Column, counted: Column, limit: Column, used: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            key.cast("string").alias("key"),
            F.coalesce(counted, F.lit(False)).cast("bigint").alias("n"),
            F.when(living, limit.cast("double")).alias("limit"),
            F.when(living, used.cast("bigint")).alias("used"),
        )

    nothing = F.lit(None)
    entries = [
        entry("part", F.col(part), living, F.col(allowed) if allowed else nothing, nothing),
        entry("item", F.col("content_item_name"), living & rows.is_not_staged(), nothing, nothing),
    ]
    if over_time:
        entries.append(entry("time", F.col(place) if place else nothing, living, F.col("test_minutes_allowed"), F.col("milliseconds_used")))
    flags = [F.coalesce(living & c, F.lit(False)).alias(f"__{step}") for step, c in conditions.items()]
    each = run.frame.select(*activity, *flags, F.inline(F.array(*entries)))
    groups = each.groupBy(*activity, "kind", "key").agg(
        F.sum("n").alias("n"),
        F.min("limit").alias("limit"),
        F.count("used").alias("known"),
        F.sum("used").alias("used"),
        *[F.max(f"__{step}").alias(f"__{step}") for step in conditions],
    )
    # each row counts for a part as well, so items shown once tell nothing more
    groups = checkpointed(groups.where((F.col("kind") != "item") | (F.col("n") > 1)))
    kind, n = F.col("kind"), F.col("n")
    bad = {step: F.col(f"__{step}") for step in conditions}
    if over_time:
        whole = F.when(F.col("known") == n, F.col("used"))
        bad["over_time"] = (kind == "time") & (milliseconds_to_minutes(whole) > F.col("limit"))
    if allowed:
        bad["too_many_questions"] = (kind == "part") & (n > F.col("limit"))
    bad["duplicate_items"] = (kind == "item") & (n > 1)
    # an activity has few parts: rows are dealt once for its verdict and for the count of their part
    coded = lambda key: F.coalesce(F.concat(F.lit("="), key), F.lit(""))
    counts = F.map_from_entries(F.collect_list(F.when(kind == "part", F.struct(coded(F.col("key")), "n"))))
    verdicts = groups.groupBy(*activity).agg(
        *[F.max(F.coalesce(c, F.lit(False))).alias(f"__{step}") for step, c in bad.items()], counts.alias("__counts")
    )
    judged = equi_join(run.frame, verdicts, activity, "left")
    count = F.try_element_at("__counts", coded(F.col(part).cast("string")))
    run.frame = judged.withColumn("actual_num_ques", count).drop("__counts")
    return list(bad)


def _later_sittings(run: _Run) -> DataFrame:
    """(activity, __later): activities that are not the first sitting, from the few columns that tell."""
    activity, student = list(run.branch.activity), ["student_id", "template_name"]
    sittings = run.living().select(*dict.fromkeys([*student, "timestamp_created", "activity_id_hist"])).distinct()
    first = sittings.groupBy(*student).agg(F.min(exclusions.sitting()).alias("__first_sitting"))
    later = equi_join(sittings, first, student, "inner").where(exclusions.is_later_sitting(F.col("__first_sitting")))
    return checkpointed(later.select(*activity).distinct()).withColumn("__later", F.lit(True))


def _item_rules(run: _Run, config: CleanConfig) -> None:
    if config.recode_answers:
        run.frame = omissions.recode_letters(run.frame)
    run.frame = omissions.add_attempted(run.frame)
    run.keep("staged", rows.is_not_staged())
    last = "staged"
    if config.remove_unscored:
        run.keep("unscored", rows.is_scored_item())
        last = "unscored"
    if run.tagged:
        # omitted by the students themselves: reported with the last rule on items
        run._tag(OMIT_STEP, ~F.col("attempted"), 0)
        if last not in run.omit_steps:
            run.omit_steps.append(last)


# Omissions -----------------------------------------------------------------------


def _omissions(
    run: _Run, config: CleanConfig, treatment: str, marked: list[DataFrame]
) -> DataFrame | None:
    run.frame = omissions.keep_originals(run.frame)
    if "__cutoff_old" in run.frame.columns:
        run.omit("version_cutoff", F.col("__cutoff_old"))
    if "__listed_old" in run.frame.columns:
        run.omit("version_list", F.col("__listed_old"))
    removed = None
    if treatment == "ignore":
        run.frame = run.frame.withColumn("repeat_omitted", F.lit(False))
    else:
        run.frame = run.branch.rank_showings(run.frame, "__rank", run.alive)
        run.frame = run.frame.withColumn("repeat_omitted", omissions.is_repeat(F.col("__rank")))
        if treatment == "remove":
            removed = _finished(run.living().where("repeat_omitted"))
            run.keep("repeat_removed", ~F.col("repeat_omitted"))
        else:
            run.omit("repeat", F.col("repeat_omitted"))
        marked.append(_finished(omissions.marked_omits(run.living())))
    limits = omissions.timing_conditions(
        run.frame.columns, config.ms_min, config.ms_max, config.sec_min, config.sec_max
    )
    for step, condition in limits.items():
        run.omit(step, condition)
    if "__old_key" in run.frame.columns:
        run.omit("old_keys", F.col("__old_key"))
    return removed


def _content(run: _Run, config: CleanConfig, inputs: CleanInputs) -> None:
    """Attach content columns; responses to unknown items are dropped."""
    if inputs.content is None:
        return
    number = run.number("content_join")
    if not run.tagged:
        run.frame = rows.attach_content(
            run.frame, inputs.content, config.extra_content, config.interaction_types
        )
        return
    keys = ["content_item_id", "content_item_name"]
    items = rows.keep_interaction_types(inputs.content.distinct(), config.interaction_types)
    items = items.select(*keys, *config.extra_content).withColumn("__known", F.lit(True))
    run.frame = equi_join(run.frame, items, keys, "left")
    run._tag(DROP_STEP, F.col("__known").isNull(), number)


# Scores and thresholds -------------------------------------------------------------


def _scores(run: _Run, config: CleanConfig, inputs: CleanInputs) -> None:
    """Attach scores and apply the thresholds.

    In a bank with sections, rows below the minimum are marked and not dropped: their
    items count for the pool.
    """
    attach, activity = run.branch.attach, list(run.branch.activity)
    sections = _has_sections(config, inputs)
    expected = "actual_num_ques" if config.question_bank else "test_num_ques"

    if not sections:
        run.frame = scoring.activity_scores(
            run.frame, expected, attach, activity, run.alive, with_omitted=not config.question_bank
        )
        if not config.question_bank:
            run.keep("below_threshold", scoring.reaches_threshold())
            return
        if config.min_items is not None:
            run.drop("below_threshold", scoring.below_bank_minimum(config.min_items))
        run.frame = scoring.student_tallies(run.frame, attach, run.alive)
        run.frame = run.branch.order_activities(run.frame, run.alive)
        return

    _need(run.frame, "section_name", "section_num_ques")
    # longest key first: rows sorted by section, activity and student serve all three
    run.frame = scoring.section_scores(run.frame, attach, activity, run.alive)
    run.frame = scoring.activity_scores(
        run.frame, expected, attach, activity, run.alive, with_omitted=False
    )
    run.frame = scoring.student_tallies(run.frame, attach, run.alive)

    if config.question_bank:
        if config.min_items is not None:
            low, reaching = scoring.below_bank_minimum(config.min_items), run.alive
            if run.tagged:
                run.drop("below_threshold", low)
            else:
                run.number("below_threshold")
                run.frame = run.frame.withColumn(BELOW, F.coalesce(low, F.lit(False)))
                reaching = ~F.col(BELOW)
            run.frame = run.branch.order_activities(run.frame, reaching)
        return

    run.frame = _expected_of_student(run, config, inputs)
    if inputs.section_map is not None and "min_items_per_seq" in inputs.section_map.columns:
        low = scoring.below_min_items(_total(inputs.section_map, "min_items_per_seq"))
    elif config.section_calc:
        _need(run.frame, "section_response_threshold")
        low = scoring.below_section_threshold()
    else:
        _need(run.frame, "test_response_threshold")
        low = scoring.below_test_threshold()
    run.attach(activity, {"__low": any_where(low, run.alive)})
    run.drop("below_threshold", F.col("__low"))


def _need(frame: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in frame.columns]
    if missing:
        raise ValueError(f"section scores need the columns {missing}")


def _expected_of_student(run: _Run, config: CleanConfig, inputs: CleanInputs) -> DataFrame:
    """Student rates over the questions of all activities the student took."""
    by_sections = inputs.test_map is None or (config.section_separated and inputs.section_map is not None)
    questions = (
        _total(inputs.section_map, "section_num_ques")
        if by_sections
        else _total(inputs.test_map, "num_ques")
    )
    run.frame = run.branch.count_activities(run.frame, run.alive)
    return scoring.student_rates(run.frame, F.col("__activities") * F.lit(questions))
