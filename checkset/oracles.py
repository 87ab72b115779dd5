"""DuckDB SQL for the registered queries, written row by row (no pre-aggregation tricks)."""

from __future__ import annotations

import re

from checkset.queries import (
    CUTOFF,
    EARLIER_DATE,
    FEW_TREES,
    HEATMAP_MODULES,
    RECENT,
    RUN_DATE,
    RUN_TS,
    SCORER,
    SPLIT_WEEK,
    STUDY_KEY,
    TREE_FEATURES,
    TWO_TREES,
)
from cohortlens.operators.boosting import LEAST_GAIN, columns_of
from cohortlens.params import RunParams
from cohortlens.schemas import CLICK_FEATURES, MODEL_FEATURES, OUTPUT_TABLES
from cohortlens.sources.adapters import FIRST_DAY, MODULE_OF_TYPE

ORACLES: dict[str, str] = {}
ATTRIBUTES = "studied_credits, age_band_num, imd_band_num, disability_flag, pass_probability_base"
PANEL_KEY = "id_student, code_module, week"
DAY = f"date_diff('day', date '{FIRST_DAY}', cast(ts as date))"
OVER = "over (partition by id_student, code_module order by week"

# ---- shared tables ------------------------------------------------------------------------

CTES = {
    "student_vle": f"""
        select case event_type {' '.join(f"when '{k}' then '{v}'" for k, v in MODULE_OF_TYPE.items())} else 'OTHER' end as code_module,
            case when event_id % 2 = 0 then '2024B' else '2024J' end as code_presentation,
            user_id as id_student, event_id % 20 as id_site, cast({DAY} as integer) as date, cast(floor(value) as bigint) as sum_click
        from events""",
    "student_assessment": f"""
        select user_id as id_student, cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as id_assessment,
            case when event_id % 10 <> 0 then cast({DAY} as integer) end as date_submitted,
            case when event_type <> 'error' then least(value, 100.0) end as score,
            0 as is_banked,
            case event_type when 'error' then 0 when 'signup' then null else 1 end as submitted
        from events""",
    "raw_assessment": """
        select * replace (case when submitted = 1 and score > 60 then '?' else cast(score as varchar) end as score)
        from student_assessment""",
    "assessments": """
        select p_partkey + 10 as id_assessment, p_size as assessment_date, cast(10.0 as double) as weight from part""",
    "student_info": """
        select c_custkey // 2 + 5 as id_student, c_mktsegment as code_module,
            case when c_custkey % 2 = 0 then '2024B' else '2024J' end as code_presentation,
            cast(cast(floor(abs(c_acctbal)) as bigint) % 120 as double) as studied_credits,
            cast(c_custkey % 3 + 1 as integer) as age_band_num, cast(c_nationkey % 9 + 1 as integer) as imd_band_num,
            cast((c_custkey // 3) % 2 as integer) as disability_flag,
            case when c_custkey % 17 <> 0 then 0.15::double + (c_custkey % 80) / 100.0::double end as pass_probability_base,
            case c_custkey % 4 when 0 then 'Pass' when 1 then 'Fail' when 2 then 'Withdrawn' else 'Distinction' end as final_result
        from customer""",
    "events_default": f"""
        select sa.id_student, si.code_module, cast(floor(coalesce(sa.date_submitted, a.assessment_date, 0) / 7.0) as integer) as week,
            coalesce(sa.score, 0.0) as score, coalesce(sa.submitted, 1) as submitted, {ATTRIBUTES}
        from student_assessment sa left join assessments a using (id_assessment)
        left join student_info si on sa.id_student = si.id_student""",
    "events_sql": """
        select sa.id_student, si.code_module, cast(coalesce(sa.date_submitted, a.assessment_date, 0) // 7 as integer) as week,
            sa.score, coalesce(sa.submitted, 1) as submitted
        from student_assessment sa left join assessments a using (id_assessment)
        left join student_info si on sa.id_student = si.id_student""",
    "weekly": """
        select id_student, week, code_module, avg(score) as weekly_score_mean, cast(sum(submitted) as bigint) as weekly_submissions,
            max(studied_credits) as studied_credits, max(age_band_num) as age_band_num, max(imd_band_num) as imd_band_num,
            max(disability_flag) as disability_flag, max(pass_probability_base) as pass_probability_base
        from events_default where id_student is not null and code_module is not null group by id_student, week, code_module""",
    "history": f"""
        select *, cast(sum(weekly_submissions) {OVER} rows unbounded preceding) as bigint) as cum_submissions,
            avg(weekly_score_mean) {OVER} rows between 2 preceding and current row) as rolling_score_3w,
            coalesce(weekly_score_mean - lag(weekly_score_mean) {OVER}), 0.0) as score_trend_2w
        from weekly""",
    "targeted": """
        select *, 0.6::double * (1 - rolling_score_3w / 100)
            + 0.2::double * greatest(0.0, least(1.0, 1 - cum_submissions / (greatest(week, 1) * 1.5::double)))
            + 0.2::double * (1 - case when pass_probability_base is null then null else greatest(0.05, least(0.99, pass_probability_base)) end)
            as blend
        from history""",
    "panel": """
        select * exclude (blend),
            case when blend is null then null else greatest(0.0, least(1.0, blend)) end as dropout_risk_target,
            case when blend is not null and greatest(0.0, least(1.0, blend)) > 0.45 then 1 else 0 end as target_high_risk
        from targeted""",
    "weekly_sql": """
        select id_student, code_module, week, avg(score) as weekly_score_mean, cast(sum(coalesce(submitted, 1)) as bigint) as weekly_submissions
        from events_sql group by 1, 2, 3""",
    "panel_sql": f"""
        select *, cast(sum(weekly_submissions) {OVER} rows unbounded preceding) as bigint) as cumulative_submissions,
            avg(weekly_score_mean) {OVER} rows between 2 preceding and current row) as rolling_3_week_mean,
            weekly_score_mean - lag(weekly_score_mean) {OVER}) as weekly_score_trend
        from weekly_sql""",
}


def margin(intercept: float) -> str:
    parts = [f"({intercept})::double"]
    for f, m, s, w in zip(SCORER.features, SCORER.means, SCORER.scales, SCORER.coefficients):
        parts.append(f"({w})::double * (({f} - ({m})::double) / ({s})::double)")
    return " + ".join(parts)


THRESHOLD = RunParams.risk_threshold
CTES |= {
    "scored": f"""
        select *, case when risk_score >= {THRESHOLD} then 1 else 0 end as high_risk_flag
        from (select *, 1.0 / (1.0 + exp(-({margin(SCORER.intercept)}))) as risk_score from panel)""",
    "scored_earlier": f"""
        select *, case when risk_score >= {THRESHOLD} then 1 else 0 end as high_risk_flag
        from (select *, 1.0 / (1.0 + exp(-({margin(-0.3)}))) as risk_score from panel)""",
    "risk": f"""
        select date '{RUN_DATE}' as run_date, id_student, code_module, week, risk_score, high_risk_flag, weekly_score_mean,
            cast(cum_submissions as double) as cum_submissions from scored""",
    "risk_runs": f"""
        select date '{EARLIER_DATE}' as run_date, id_student, code_module, week, risk_score, high_risk_flag, weekly_score_mean,
            cast(cum_submissions as double) as cum_submissions from scored_earlier
        union all select * from risk""",
    "scores": f"""
        select timestamp '{RUN_TS}' as run_date, week, id_student, code_module, risk_score, high_risk_flag, 'v1' as model_version,
            'logistic' as model_backend, {THRESHOLD}::double as threshold, timestamp '{RUN_TS}' as created_at from risk""",
    "summary": """
        select run_date, week, code_module, count(distinct id_student) as student_count, avg(risk_score) as avg_risk_score,
            avg(high_risk_flag) as high_risk_rate from risk_runs group by 1, 2, 3""",
    "risk_weekly": f"""
        select s.run_date, s.week, s.id_student, s.code_module, s.risk_score, s.high_risk_flag, f.weekly_score_mean, f.weekly_submissions,
            f.cumulative_submissions, f.rolling_3_week_mean, f.weekly_score_trend, {ATTRIBUTES},
            s.model_version, s.model_backend, s.threshold, s.created_at
        from scores s
        left join panel_sql f on s.id_student = f.id_student and s.code_module = f.code_module and s.week = f.week
        left join student_info i on s.id_student = i.id_student and s.code_module = i.code_module""",
    "summary_sql": """
        select run_date, week, code_module, count(distinct id_student) as students, avg(risk_score) as avg_risk_score,
            cast(sum(high_risk_flag) as bigint) as high_risk_students from risk_weekly group by 1, 2, 3""",
    "last_snap": "select * from scored where week = (select max(week) from scored)",
    "snap": f"select * from scored where week = {SPLIT_WEEK}",
    "vle_cut": f"select * from student_vle where date <= {CUTOFF}",
    "daily": """
        select code_module, code_presentation, id_student, date, cast(sum(sum_click) as bigint) as day_clicks
        from vle_cut group by 1, 2, 3, 4""",
    "feature_a": "select code_module, code_presentation, id_student, cast(sum(sum_click) as bigint) as total_clicks from vle_cut group by 1, 2, 3",
    "feature_b": "select code_module, code_presentation, id_student, stddev_samp(day_clicks) as click_stability_std from daily group by 1, 2, 3",
    "feature_c": """
        select code_module, code_presentation, id_student, cast(sum(sum_click) as bigint) as early_preview_clicks
        from vle_cut where date < 0 group by 1, 2, 3""",
    "feature_d": f"""
        select code_module, code_presentation, id_student, cast(sum(sum_click) as bigint) as recent_trend_clicks
        from vle_cut where date > {CUTOFF - RECENT} group by 1, 2, 3""",
    "click_features": """
        select a.*, click_stability_std, early_preview_clicks, recent_trend_clicks from feature_a a
        left join feature_b using (code_module, code_presentation, id_student)
        left join feature_c using (code_module, code_presentation, id_student)
        left join feature_d using (code_module, code_presentation, id_student)""",
    "assignment_features": """
        select id_student, avg(score) as avg_assignment_score, count(score) as assignment_submission_count from student_assessment group by 1""",
    "study": """
        select code_module, code_presentation, id_student, final_result, coalesce(total_clicks, 0) as total_clicks,
            coalesce(click_stability_std, 0.0) as click_stability_std, coalesce(early_preview_clicks, 0) as early_preview_clicks,
            coalesce(recent_trend_clicks, 0) as recent_trend_clicks, coalesce(avg_assignment_score, 0.0) as avg_assignment_score,
            coalesce(assignment_submission_count, 0) as assignment_submission_count,
            case when final_result in ('Pass', 'Distinction') then 1 else 0 end as target
        from (select code_module, code_presentation, id_student, final_result from student_info)
        left join click_features using (code_module, code_presentation, id_student)
        left join assignment_features using (id_student)""",
    "evaluated": f"""
        select * from scored where week >= {SPLIT_WEEK} and {' and '.join(f'{c} is not null' for c in MODEL_FEATURES)}""",
}
def uses(sql: str, tables: dict[str, str]) -> set[str]:
    """Shared tables named in ``sql``, with those they need in turn."""
    found: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"[a-z_]+", todo.pop()))
        fresh = [t for t in tables if t in words and t not in found]
        found.update(fresh)
        todo += [tables[t] for t in fresh]
    return found


def oracle(name: str, sql: str, doubles: str = "", **replaced: str) -> None:
    """Register ``sql`` with the shared tables it names; ``doubles`` are rounded like in the queries.

    ``replaced`` gives other bodies to shared tables.
    """
    tables = CTES | replaced
    needed = uses(sql, tables)
    head = ",\n".join(f"{t} as ({tables[t]})" for t in tables if t in needed)
    head = f"with {head}\n" if head else ""
    if doubles:
        parts = ", ".join(f"round({c.strip()} + 1e-9, 6) as {c.strip()}" for c in doubles.split(","))
        sql = f"select * replace ({parts}) from ({sql})"
    ORACLES[name] = head + sql


def uniform(seed: int | str, *keys: str) -> str:
    text = " || '|' || ".join([f"cast({k} as varchar)" for k in keys] + [f"'{seed}'"])
    return f"(cast(('0x' || substr(md5({text}), 1, 8)) as bigint) / 4294967296.0::double)"


# ---- staging and events ------------------------------------------------------------------

INFO = f"select id_student, code_module, {ATTRIBUTES} from student_info"
SUBMISSION = "id_student, id_assessment, date_submitted, score, is_banked, coalesce(submitted, 1) as submitted"
oracle("stage_student_info", INFO, "studied_credits, pass_probability_base")
oracle("stage_student_info_sql", INFO, "studied_credits, pass_probability_base")
oracle("stage_student_assessment", f"select {SUBMISSION.replace('score', 'try_cast(score as double) as score')} from raw_assessment", "score")
oracle("stage_student_assessment_sql", f"select {SUBMISSION} from student_assessment", "score")
oracle("stage_assessments", "select * from assessments")
oracle("stage_risk_scores", "select * from scores", "risk_score")
EVENT_DOUBLES = "score, studied_credits, pass_probability_base"
EVENTS_RAW = CTES["events_default"].replace("sa.score", "try_cast(sa.score as double)").replace("from student_assessment", "from raw_assessment")
oracle("clean_events", EVENTS_RAW, EVENT_DOUBLES)
oracle("clean_events_sql", "select * from events_sql", "score")
oracle(
    "dated_submissions",
    """select sa.id_student, cast(floor(coalesce(sa.date_submitted, a.assessment_date, 0) / 7.0) as integer) as week,
        coalesce(sa.score, 0.0) as score, coalesce(sa.submitted, 1) as submitted
    from student_assessment sa left join assessments a using (id_assessment)""",
    "score",
)
oracle(
    "events_missing_columns",
    """select id_student, code_module, week, 0.0::double as score, 1 as submitted, 0 as studied_credits, age_band_num, 0 as imd_band_num,
        disability_flag, pass_probability_base from events_default""",
    "pass_probability_base",
)
oracle(
    "events_safe_key",
    f"""select sa.id_student, si.code_module, cast(floor(coalesce(sa.date_submitted, a.assessment_date, 0) / 7.0) as integer) as week,
        coalesce(sa.score, 0.0) as score, coalesce(sa.submitted, 1) as submitted, {ATTRIBUTES}
    from student_assessment sa left join assessments a using (id_assessment)
    left join student_info si on sa.id_student = si.id_student
        and si.code_presentation = case when sa.id_assessment % 2 = 0 then '2024B' else '2024J' end""",
    EVENT_DOUBLES,
)
oracle("event_table_sink", "select * from events_default", EVENT_DOUBLES)

# ---- weekly panel --------------------------------------------------------------------------

WEEKLY_DOUBLES = "weekly_score_mean, studied_credits, pass_probability_base"
PANEL_DOUBLES = f"{WEEKLY_DOUBLES}, rolling_score_3w, score_trend_2w, dropout_risk_target"
for name in ("weekly_features", "weekly_features_from_events"):
    oracle(name, "select * from panel", PANEL_DOUBLES)
for name in ("weekly_features_sql", "raw_landing"):
    oracle(name, "select * from panel_sql", "weekly_score_mean, rolling_3_week_mean, weekly_score_trend")
oracle("weekly_aggregate", "select * from weekly", WEEKLY_DOUBLES)
oracle("weekly_aggregate_sql", "select * from weekly_sql", "weekly_score_mean")
oracle("cum_submissions", f"select {PANEL_KEY}, cum_submissions from panel")
oracle("rolling_score", f"select {PANEL_KEY}, rolling_score_3w from panel", "rolling_score_3w")
oracle("score_trend", f"select {PANEL_KEY}, score_trend_2w from panel", "score_trend_2w")
oracle("score_trend_sql", f"select {PANEL_KEY}, weekly_score_trend from panel_sql", "weekly_score_trend")
oracle("risk_target", f"select {PANEL_KEY}, dropout_risk_target, target_high_risk from panel", "dropout_risk_target")
oracle(
    "course_target_summary",
    """select week, code_module, count(distinct id_student) as student_count, avg(dropout_risk_target) as avg_target,
        avg(target_high_risk) as at_risk_share from panel group by 1, 2""",
    "avg_target, at_risk_share",
)
MEAN_TARGET = "select week, avg(dropout_risk_target) as mean_target from panel group by week"
oracle("weekly_target_mean", MEAN_TARGET, "mean_target")
SPIKE = f"""
    select case when weeks = 1 then 0.0 else (current_mean - prior_mean) / greatest(prior_mean, 1e-9) end as spike_pct, prior_mean, current_mean, weeks
    from (select count(*) over () as weeks, mean_target as current_mean, lag(mean_target) over (order by week) as prior_mean, week
        from (select * from ({MEAN_TARGET}) order by week desc limit 2)) order by week desc limit 1"""
oracle("week_over_week", SPIKE, "spike_pct, prior_mean, current_mean")

# ---- clickstream study ---------------------------------------------------------------------

STUDY_DOUBLES = "click_stability_std, avg_assignment_score"
oracle("daily_clicks", "select * from daily")
for name in ("click_features", "click_csv_scan"):
    oracle(name, "select * from click_features", "click_stability_std")
oracle("assignment_features", "select * from assignment_features", "avg_assignment_score")
oracle(
    "assignment_features_outer",
    """select id_student, avg_assignment_score, assignment_submission_count
    from (select id_student, avg(score) as avg_assignment_score from student_assessment where score is not null group by 1)
    full join (select id_student, count(score) as assignment_submission_count from student_assessment group by 1) using (id_student)""",
    "avg_assignment_score",
)
oracle("click_study_matrix", "select * from study", STUDY_DOUBLES)
oracle(
    "click_row_counts",
    f"""select count(*) as all_rows, count(*) filter (date <= {CUTOFF}) as cutoff_rows, count(*) filter (date < 0) as early_rows,
        count(*) filter (date > {CUTOFF - RECENT} and date <= {CUTOFF}) as recent_rows from student_vle""",
)
oracle("target_counts", 'select target, count(*) as rows, count(*) / sum(count(*)) over () as share from study group by target', "share")
oracle(
    "column_summary",
    " union all ".join(
        f"""select '{c}' as feature, count({c}) as count, avg({c}) as mean, stddev_samp({c}) as std, cast(min({c}) as double) as min,
        quantile_cont(cast({c} as double), 0.25) as p25, quantile_cont(cast({c} as double), 0.5) as p50,
        quantile_cont(cast({c} as double), 0.75) as p75, cast(max({c}) as double) as max from study"""
        for c in CLICK_FEATURES
    ),
    "mean, std, min, p25, p50, p75, max",
)
oracle(
    "correlations",
    " union all ".join(
        f"select '{a}' as feature_x, '{b}' as feature_y, corr({a}, {b}) as correlation from study" for a in CLICK_FEATURES for b in CLICK_FEATURES
    ),
    "correlation",
)
oracle("preview", "select id_student, code_presentation, code_module, final_result from student_info order by 1, 2 limit 5")

# ---- scores and marts ------------------------------------------------------------------------

oracle(
    "standardised_features",
    f"select {PANEL_KEY}, "
    + ", ".join(f"case when stddev_pop({c}) over () = 0 then 0.0 else ({c} - avg({c}) over ()) / stddev_pop({c}) over () end as z_{c}" for c in MODEL_FEATURES)
    + " from panel",
    ", ".join(f"z_{c}" for c in MODEL_FEATURES),
)
for name in ("linear_score", "foreign_model_score"):
    oracle(name, f"select {PANEL_KEY}, risk_score, high_risk_flag from scored", "risk_score")
for name, table in (("risk_snapshot", "last_snap"), ("risk_snapshot_absent_week", "last_snap"), ("risk_snapshot_week", "snap")):
    oracle(name, f"select {PANEL_KEY}, risk_score, high_risk_flag from {table}", "risk_score")
oracle("scored_order", f"select {PANEL_KEY}, risk_score from scored", "risk_score")
RISK_DOUBLES = "risk_score, weekly_score_mean, cum_submissions"
oracle("student_risk_mart", "select * from risk", RISK_DOUBLES)
oracle("risk_score_history", "select * from scores", "risk_score")
SUMMARY_DOUBLES = "avg_risk_score, high_risk_rate"
oracle("course_summary", f"select * from summary where run_date = date '{RUN_DATE}'", SUMMARY_DOUBLES)
oracle(
    "course_summary_distinct",
    """select run_date, week, code_module, count(distinct id_student) as student_count, avg(risk_score) as avg_risk_score,
        avg(high_risk_flag) as high_risk_rate from (select * from risk_runs union all select * from risk) group by 1, 2, 3""",
    SUMMARY_DOUBLES,
)
oracle("course_summary_sql", "select * from summary_sql", "avg_risk_score")
oracle(
    "risk_weekly_mart",
    "select * from risk_weekly",
    "risk_score, weekly_score_mean, rolling_3_week_mean, weekly_score_trend, studied_credits, pass_probability_base",
)
oracle("course_dimension", "select distinct code_module from summary")
oracle("mart_to_course", "select * from summary join (select distinct code_module from summary) using (code_module)", SUMMARY_DOUBLES)
BY_RISK = "order by risk_score desc, id_student, code_module"
TOP = f"select {PANEL_KEY}, risk_score from snap {BY_RISK} limit {RunParams.top_k}"
oracle("top_k_at_risk", TOP, "risk_score")
oracle("top_ids", f"select cast(id_student as varchar) as id_student from (select * from snap {BY_RISK} limit 10)")
oracle("run_day_top", f"select * from risk_runs where run_date = date '{RUN_DATE}' {BY_RISK} limit 100", RISK_DOUBLES)
oracle("course_ranking", "select run_date, code_module, student_count, avg_risk_score, high_risk_rate from summary", SUMMARY_DOUBLES)
oracle("course_order_by_week", "select * from summary", SUMMARY_DOUBLES)
oracle(
    "top_courses",
    """select * from (select *, cast(row_number() over (partition by run_date, week order by high_risk_rate desc, code_module) as integer) as place
        from summary) where place <= 3""",
    SUMMARY_DOUBLES,
)
oracle("latest_run", "select * from risk_runs where run_date = (select max(run_date) from risk_runs)", RISK_DOUBLES)
oracle("risk_trend", "select run_date, week, avg(risk_score) as avg_risk_score from risk_runs group by 1, 2", "avg_risk_score")
oracle("risk_histogram", "select cast(least(floor(risk_score * 20) + 1, 20) as integer) as bin, count(*) as rows from risk group by 1")
oracle(
    "module_heatmap",
    f"select week, code_module, avg(high_risk_rate) as high_risk_rate from summary where run_date = date '{RUN_DATE}' group by 1, 2",
    "high_risk_rate",
)
oracle(
    "mart_verification",
    """select min(week) as min_week, max(week) as max_week, count(distinct week) as weeks, count(*) as rows, count(risk_score) as scored_rows from risk""",
)
oracle("rows_per_week", "select week, count(*) as rows from risk group by week order by week limit 20")
oracle(
    "risk_message",
    """select week, printf('%.2f%%', 100.0 * sum(high_risk_flag) / count(*)) || ' | ' || cast(count(*) as varchar) as message
    from scored group by week""",
)

# ---- alerts and checks -----------------------------------------------------------------------


def alert(table: str, run_ts: str) -> str:
    over_rate, over_spike = f"high_risk_rate > {THRESHOLD}", f"spike_pct > {RunParams.spike_threshold}"
    return f"""
    select timestamp '{run_ts}' as run_ts,
        case when {over_rate} and {over_spike} then 'threshold_and_spike' when {over_rate} then 'threshold'
            when {over_spike} then 'spike' else 'none' end as alert_type,
        high_risk_rate, spike_pct,
        concat_ws(' | ',
            case when {over_rate} then printf('- Threshold alert: high-risk rate %.2f%% > configured %.2f%%.', 100 * high_risk_rate, {100 * THRESHOLD}) end,
            case when {over_spike} then printf('- Spike alert: mean risk increased %.2f%% WoW > configured %.2f%%.', 100 * spike_pct, {100 * RunParams.spike_threshold}) end,
            case when not ({over_rate}) and not ({over_spike}) then '- No alert triggered; metrics remain within configured limits.' end) as message
    from (select avg(high_risk_flag) as high_risk_rate from {table}) cross join (select spike_pct from ({SPIKE}))"""


oracle("snapshot_stats", "select avg(high_risk_flag) as high_risk_rate, count(*) as snapshot_rows from snap", "high_risk_rate")
oracle("alert_row", alert("snap", RUN_TS), "high_risk_rate, spike_pct")
oracle("alert_timeline", f"{alert('last_snap', f'{EARLIER_DATE} 06:30:15')} union all {alert('snap', RUN_TS)}", "high_risk_rate, spike_pct")


def check(table: str, column: str, kind: str, failing: str, source: str) -> str:
    return f"""select '{table}' as "table", '{column}' as "column", '{kind}' as "check", n as failing_rows, n = 0 as passed
        from (select cast({failing} as bigint) as n from {source})"""


def null_check(table: str, column: str, source: str) -> str:
    return check(table, column, "not_null", f"count(*) filter ({column} is null)", source)


def unique_check(table: str, column: str, source: str) -> str:
    groups = f"(select {column} from {source} where {column} is not null group by 1 having count(*) > 1)"
    return check(table, column, "unique", "count(*)", groups)


def several_check(table: str, column: str, source: str) -> str:
    return check(table, column, "several_values", f"case when count(distinct {column}) <= 1 then 1 else 0 end", source)


oracle(
    "quality_checks",
    " union all ".join(
        [
            null_check("stg_student_info", "id_student", "student_info"),
            null_check("stg_student_info", "code_module", "student_info"),
            null_check("stg_student_assessment", "id_student", "student_assessment"),
            null_check("stg_student_assessment", "id_assessment", "student_assessment"),
            null_check("stg_assessments", "id_assessment", "assessments"),
            unique_check("stg_assessments", "id_assessment", "assessments"),
            null_check("mart_student_risk_weekly", "run_date", "risk_weekly"),
            null_check("mart_student_risk_weekly", "risk_score", "risk_weekly"),
            check("mart_student_risk_weekly", "risk_score", "not_all_null", "case when count(risk_score) = 0 then 1 else 0 end", "risk_weekly"),
            several_check("mart_student_risk_weekly", "week", "risk_weekly"),
            null_check("mart_course_summary_weekly", "run_date", "summary_sql"),
            null_check("mart_course_summary_weekly", "code_module", "summary_sql"),
            several_check("mart_course_summary_weekly", "week", "summary_sql"),
        ]
    ),
)
oracle(
    "failing_checks",
    " union all ".join(
        [
            null_check("events", "code_module", "events_sql"),
            null_check("events", "id_student", "events_sql"),
            null_check("events", "score", "events_sql"),
            several_check("events", "week", "events_sql"),
            unique_check("student_info", "id_student", "student_info"),
        ]
    ),
)

# ---- experiments -------------------------------------------------------------------------------

COHORT = f"""
    select *, case when {uniform(42, 'id_student', 'code_module')} < 0.5 then 'control' else 'treatment' end as arm,
        greatest(0.05, least(0.95, 1 - risk_score)) as base_pass_prob from ({TOP})"""
oracle("arm_assignment", COHORT, "risk_score, base_pass_prob")
UPLIFTS = ", ".join(f"({u}::double)" for u in RunParams.uplifts)
SCENARIOS = f"""
    select *, case when arm = 'treatment' then greatest(0.0, least(1.0, base_pass_prob + uplift_scenario)) else base_pass_prob end as sim_pass_prob
    from ({COHORT}) cross join (values {UPLIFTS}) as u(uplift_scenario)"""
oracle("scenario_grid", SCENARIOS, "risk_score, base_pass_prob, uplift_scenario, sim_pass_prob")
PASSED_IN = {0.03: "'Pass', 'Distinction'", 0.05: "'Pass', 'Distinction', 'Fail'", 0.08: "'Distinction', 'Withdrawn'"}
OUTCOMES = " union all ".join(
    f"""select {u}::double as uplift_scenario, case when {uniform(42, 'id_student', 'code_presentation')} < 0.5 then 'control' else 'treatment' end as arm,
        case when final_result in ({passed}) then 1 else 0 end as outcome from student_info"""
    for u, passed in PASSED_IN.items()
)
SEEN = " union all ".join(
    f"""select id_student, code_module, {u}::double as uplift_scenario, max(case when final_result in ({passed}) then 1 else 0 end) as outcome
        from student_info group by 1, 2"""
    for u, passed in PASSED_IN.items()
)
COHORT_OUTCOMES = f"""
    select uplift_scenario, arm, outcome from ({SCENARIOS}) left join ({SEEN}) using (id_student, code_module, uplift_scenario)"""


def rates(outcomes: str) -> str:
    return f"""
    select *, treatment_rate - control_rate as rate_diff from (
        select *, control_success / control_n as control_rate, treatment_success / treatment_n as treatment_rate from (
            select uplift_scenario, count(outcome) filter (arm = 'control') as control_n,
                cast(coalesce(sum(outcome) filter (arm = 'control'), 0) as bigint) as control_success,
                count(outcome) filter (arm = 'treatment') as treatment_n,
                cast(coalesce(sum(outcome) filter (arm = 'treatment'), 0) as bigint) as treatment_success,
                count(*) - count(outcome) as without_outcome
            from ({outcomes}) group by 1))"""


def erfc(x: str, cut: float = 2.5, terms: int = 60, levels: int = 40) -> str:
    square = f"({x} * {x})"
    series = "1.0"
    for n in range(terms, 0, -1):
        series = f"(1.0 + {series} * {square} * {2.0 / (2 * n + 1)!r})"
    fraction = x
    for n in range(levels, 0, -1):
        fraction = f"({x} + {n / 2.0} / {fraction})"
    return f"""case when {x} < {cut} then 1.0 - {x} * exp(-{square}) * {series} * (2.0 / sqrt(pi()))
        else exp(-{square}) / (sqrt(pi()) * {fraction}) end"""


def tested(outcomes: str) -> str:
    return f"""
    select * exclude (error, x), case when error = 0 then 1.0 else {erfc('x')} end as p_value from (
        select *, abs(rate_diff / nullif(error, 0)) / sqrt(2.0::double) as x from (
            select *, sqrt(((control_success + treatment_success) / (control_n + treatment_n))
                * (1 - (control_success + treatment_success) / (control_n + treatment_n)) * (1.0::double / control_n + 1.0::double / treatment_n)) as error
            from ({rates(outcomes)})))"""


def interval(outcomes: str) -> str:
    """Binomial draws by inversion: the smallest count whose distribution function reaches a hash number."""
    arms = " union all ".join(f"select uplift_scenario, '{a}' as arm, {a}_n as n, {a}_success as s, {a}_success / {a}_n as p from r" for a in ("control", "treatment"))
    reach = "12 * sqrt(n * p * (1 - p)) + 20"
    return f"""
    select uplift_scenario, quantile_cont(diff, 0.025) as ci_low, quantile_cont(diff, 0.975) as ci_high from (
        with r as (select * from ({rates(outcomes)}) where control_n > 0 and treatment_n > 0),
        a as (select *, cast(greatest(0, floor(n * p - ({reach}))) as bigint) as low, cast(least(n, ceil(n * p + {reach})) as bigint) as high from ({arms})),
        k as (select *, unnest(range(low, high + 1)) as k from a where s > 0 and s < n),
        l as (select *, sum(case when k > low then ln((n - k + 1) / k * p / (1 - p)) else 0.0 end)
            over (partition by uplift_scenario, arm order by k rows unbounded preceding) as l from k),
        m as (select *, exp(l - max(l) over (partition by uplift_scenario, arm)) as m from l),
        c as (select *, sum(m) over (partition by uplift_scenario, arm order by k rows unbounded preceding)
            / sum(m) over (partition by uplift_scenario, arm) as c from m),
        u as (select *, (cast(('0x' || substr(md5(rep || '|' || arm || '|42'), 1, 8)) as bigint) / 4294967296.0::double) as u
            from (select *, unnest(range(0, 2000)) as rep from a)),
        d as (select u.uplift_scenario, u.arm, u.rep, case when u.s = 0 or u.s = u.n then u.s else coalesce(c.k + 1, u.low) end / u.n as share
            from u asof left join c on u.uplift_scenario = c.uplift_scenario and u.arm = c.arm and u.u > c.c)
        select uplift_scenario, rep, sum(case when arm = 'treatment' then share else -share end) as diff from d group by 1, 2) group by 1"""


RATE_DOUBLES = "uplift_scenario, control_rate, treatment_rate, rate_diff"
oracle("arm_rates", rates(OUTCOMES), RATE_DOUBLES)
oracle("z_test", tested(OUTCOMES), f"{RATE_DOUBLES}, p_value")
oracle("bootstrap_ci", interval(OUTCOMES), "uplift_scenario, ci_low, ci_high")
READOUT = f"""select timestamp '{RUN_TS}' as run_ts, uplift_scenario, control_rate, treatment_rate, rate_diff, p_value, ci_low, ci_high
    from ({tested(COHORT_OUTCOMES)}) join ({interval(COHORT_OUTCOMES)}) using (uplift_scenario)"""
for name in ("experiment_readout", "experiment_listing"):
    oracle(name, READOUT, f"{RATE_DOUBLES}, p_value, ci_low, ci_high")
ROI_UPLIFTS = ", ".join(f"({u}::double)" for u in RunParams.roi_uplifts)
ROI_COSTS = ", ".join(f"({c})" for c in RunParams.roi_costs)


def roi(targeted: str, by: str = "") -> str:
    return f"""
    select {by} top_k_students, uplift_assumption, cost_per_student, {RunParams.value_per_pass}::double as value_per_pass,
        top_k_students * uplift_assumption as incremental_passes,
        top_k_students * uplift_assumption * {RunParams.value_per_pass}::double - top_k_students * cost_per_student as roi
    from (select {by} count(*) as top_k_students from ({targeted}) {'group by ' + by.rstrip(', ') if by else ''})
    cross join (values {ROI_UPLIFTS}) as u(uplift_assumption) cross join (values {ROI_COSTS}) as c(cost_per_student)"""


ROI_DOUBLES = "uplift_assumption, value_per_pass, incremental_passes, roi"
oracle(
    "roi_grid",
    f"""select *, (select max(rate_diff) from ({rates(COHORT_OUTCOMES)}) where uplift_scenario = 0.05) as reference_diff_from_5pct_sim
    from ({roi(COHORT)})""",
    f"{ROI_DOUBLES}, reference_diff_from_5pct_sim",
)
oracle("roi_grid_by_module", roi(COHORT, "code_module, "), ROI_DOUBLES)
BEST = f"select * from ({roi(COHORT)}) order by roi desc, uplift_assumption, cost_per_student limit 1"
oracle("best_roi", BEST, ROI_DOUBLES)

# ---- splits and evaluation ---------------------------------------------------------------------

MODEL_ROWS = f"select * from panel where {' and '.join(f'{c} is not null' for c in [*MODEL_FEATURES, 'target_high_risk'])}"
oracle(
    "model_rows",
    f"select {PANEL_KEY}, {', '.join(MODEL_FEATURES)}, target_high_risk from ({MODEL_ROWS})",
    "weekly_score_mean, studied_credits, rolling_score_3w, score_trend_2w",
)
oracle(
    "week_range",
    "select min(week) as min_week, max(week) as max_week, quantile_cont(cast(week as double), 0.7) as week_quantile from panel",
    "week_quantile",
)
for name, at in (
    ("time_split", f"(select least({SPLIT_WEEK}, max(week)) from ({MODEL_ROWS}))"),
    ("time_split_fallback", f"(select trunc(quantile_cont(cast(week as double), 0.7)) from ({MODEL_ROWS}))"),
):
    oracle(name, f"select case when week < {at} then 'train' else 'test' end as side, count(*) as rows from ({MODEL_ROWS}) group by 1")
oracle(
    "stratified_split",
    f"""select id_student, code_presentation, code_module, target, case when place <= quota then 'test' else 'train' end as side from (
        select *, row_number() over (partition by target order by u, id_student, code_presentation) as place from (
            select *, {uniform(42, 'id_student', 'code_presentation')} as u from study))
    join (select target, cls - floor(exact) - case when row_number() over (order by exact - floor(exact) desc, target)
                <= train - sum(floor(exact)) over () then 1 else 0 end as quota from (
            select target, cls, train, train * cls / total as exact from (
                select target, cls, total, total - ceil(total * 0.2) as train from (
                    select target, count(*) as cls, sum(count(*)) over () as total from study group by target))))
    using (target)""",
)
oracle(
    "row_sample",
    f"""select {PANEL_KEY}, weekly_score_mean from (select *, {uniform(42, 'id_student', 'code_module', 'week')} as u from panel
    order by u, id_student, code_module, week limit 200)""",
    "weekly_score_mean",
)
COUNTS = """
    select count(*) filter (target_high_risk = 0 and risk_score < 0.5) as tn, count(*) filter (target_high_risk = 0 and risk_score >= 0.5) as fp,
        count(*) filter (target_high_risk = 1 and risk_score < 0.5) as fn, count(*) filter (target_high_risk = 1 and risk_score >= 0.5) as tp
    from evaluated"""
oracle("confusion", COUNTS)
oracle(
    "precision_recall",
    f"select tp / greatest(tp + fp, 1) as precision_at_cut, tp / greatest(tp + fn, 1) as recall_at_cut from ({COUNTS})",
    "precision_at_cut, recall_at_cut",
)


def ratio(top: str, bottom: str) -> str:
    return f"coalesce(({top}) / nullif({bottom}, 0), 0.0)"


CLASSES = f"""
    select '0' as class, {ratio('tn', 'tn + fn')} as precision, {ratio('tn', 'tn + fp')} as recall,
        {ratio('2.0 * tn', '2 * tn + fn + fp')} as f1, tn + fp as support from ({COUNTS})
    union all select '1', {ratio('tp', 'tp + fp')}, {ratio('tp', 'tp + fn')}, {ratio('2.0 * tp', '2 * tp + fp + fn')}, tp + fn from ({COUNTS})"""
oracle(
    "classification_report",
    f"""{CLASSES}
    union all select 'accuracy', null, null, (tn + tp) / (tn + fp + fn + tp), tn + fp + fn + tp from ({COUNTS})
    union all select 'macro avg', avg(precision), avg(recall), avg(f1), cast(sum(support) as bigint) from ({CLASSES})
    union all select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
        sum(f1 * support) / sum(support), cast(sum(support) as bigint) from ({CLASSES})""",
    "precision, recall, f1",
)
# rank-sum form: an independent way to the area under the ROC curve
AUC = """
    select (sum(place) filter (target_high_risk = 1) - p * (p + 1) / 2.0) / (p * n) as auc from (
        select target_high_risk, rank() over (order by risk_score) + (count(*) over (partition by risk_score) - 1) / 2.0 as place,
            count(*) filter (target_high_risk = 1) over () as p, count(*) filter (target_high_risk = 0) over () as n from evaluated)
    group by p, n"""
CURVE = """
    select threshold, sum(pos) over (order by threshold desc) as tps, sum(neg) over (order by threshold desc) as fps, sum(pos) over () as p, sum(neg) over () as n
    from (select risk_score as threshold, count(*) filter (target_high_risk = 1) as pos, count(*) filter (target_high_risk = 0) as neg
        from evaluated group by 1)"""
PR_AUC = f"""
    select sum((recall - r0) * (precision + p0) / 2) as pr_auc from (
        select precision, recall, lag(precision, 1, 1.0) over (order by threshold desc) as p0, lag(recall, 1, 0.0) over (order by threshold desc) as r0
        from (select threshold, tps / (tps + fps) as precision, tps / p as recall from ({CURVE})))"""
oracle("roc_auc", AUC, "auc")
oracle("pr_auc", PR_AUC, "pr_auc")
oracle(
    "roc_points",
    f"""select threshold, fps / n as fpr, tps / p as tpr from ({CURVE}) union all select null, 0.0, 0.0""",
    "threshold, fpr, tpr",
)
METRICS = f"""
    select auc, pr_auc, tp / greatest(tp + fp, 1) as precision_at_0_5, tp / greatest(tp + fn, 1) as recall_at_0_5
    from ({AUC}) cross join ({PR_AUC}) cross join ({COUNTS})"""
METRIC_DOUBLES = "auc, pr_auc, precision_at_0_5, recall_at_0_5"
oracle(
    "run_summary",
    f"""select m.*, uplift_assumption as best_uplift, cost_per_student as best_cost, roi as best_roi from ({METRICS}) m cross join ({BEST})""",
    f"{METRIC_DOUBLES}, best_uplift, best_roi",
)
oracle(
    "metric_json",
    f"select m.*, 'logistic' as model_backend, tn, fp, fn, tp from ({METRICS}) m cross join ({COUNTS})",
    METRIC_DOUBLES,
)


def contributions(rows: str) -> str:
    z = {f: f"({f} - ({m})::double) / ({s})::double" for f, m, s in zip(SCORER.features, SCORER.means, SCORER.scales)}
    return " union all ".join(
        f"""select '{f}' as feature, avg(abs(({w})::double * (z - m))) as mean_abs_contribution
        from (select {z[f]} as z, avg({z[f]}) over () as m from ({rows}))"""
        for f, w in zip(SCORER.features, SCORER.coefficients)
    )


SAMPLE = f"select *, {uniform(42, 'id_student', 'code_module', 'week')} as u from ({MODEL_ROWS}) order by u, id_student, code_module, week limit 200"
oracle("linear_contributions", contributions(MODEL_ROWS), "mean_abs_contribution")
oracle("top_features", f"select * from ({contributions(SAMPLE)}) order by mean_abs_contribution desc, feature limit 5", "mean_abs_contribution")

oracle("top_feature_map", f"select * from ({contributions(MODEL_ROWS)}) order by mean_abs_contribution desc, feature limit 5", "mean_abs_contribution")
oracle("model_save", f"select count(*) as rows, cast(0 as bigint) as different from ({MODEL_ROWS}) where week < {SPLIT_WEEK}")



def permuted() -> str:
    """Mean loss of area when a feature comes from the row a step further on in a random order, one step per repeat."""
    names = ", ".join(f"cast({f} as double) as {f}" for f in MODEL_FEATURES)
    others = ", ".join(f"d.{f} as other_{f}" for f in MODEL_FEATURES)
    variants = " union all ".join(
        f"select rep, '{f}' as feature, target_high_risk, 1.0 / (1.0 + exp(-({margin(SCORER.intercept).replace(f'(({f} -', f'((other_{f} -')}))) as score from pairs"
        for f in MODEL_FEATURES
    )
    area = """select rep, feature, (sum(place) filter (target_high_risk = 1) - p * (p + 1) / 2.0) / (p * n) as auc from (
        select rep, feature, target_high_risk, rank() over (partition by rep, feature order by score) + (count(*) over (partition by rep, feature, score) - 1) / 2.0 as place,
            count(*) filter (target_high_risk = 1) over (partition by rep, feature) as p, count(*) filter (target_high_risk = 0) over (partition by rep, feature) as n
        from {}) group by rep, feature, p, n"""
    return f"""
    with placed as materialized (
        select row_number() over (order by u, id_student, code_module, week) - 1 as place, count(*) over () as n, target_high_risk, {names}
        from (select *, {uniform(42, 'id_student', 'code_module', 'week')} as u from evaluated)),
    pairs as materialized (
        select r.rep, p.*, {others} from placed p cross join (select unnest(range(1, 11)) as rep) r
        join placed d on d.place = (p.place + 1 + cast(floor({uniform(42, 'r.rep')} * greatest(p.n - 1, 1)) as bigint)) % p.n),
    variants as materialized ({variants}),
    base as (select 0 as rep, '' as feature, target_high_risk, 1.0 / (1.0 + exp(-({margin(SCORER.intercept)}))) as score from placed)
    select v.feature, avg(b.auc - v.auc) as importance, stddev_pop(b.auc - v.auc) as importance_std
    from ({area.format('variants')}) v cross join ({area.format('base')}) b group by v.feature"""


oracle("permutation_importance", permuted(), "importance, importance_std")


def newton_sql(rows: str, features: list[str], label: str, steps: int = 9) -> str:
    """Newton's method, a step a block: sums over all rows, then a Gauss-Jordan elimination of the small system, a pivot a table."""
    k = len(features) + 1
    z = [f"case when s_{f} > 0 then (cast({f} as double) - m_{f}) / s_{f} else 0.0 end as z{i + 1}" for i, f in enumerate(features)]
    moments = ", ".join(f"avg(cast({f} as double)) as m_{f}, stddev_pop(cast({f} as double)) as s_{f}" for f in features)
    parts = [
        f"base as ({rows})",
        f"z as materialized (select {', '.join(z)}, 1.0::double as z{k}, cast({label} as double) as y from base cross join (select {moments} from base))",
        f"b0 as (select {', '.join(f'0.0::double as b{i + 1}' for i in range(k))})",
    ]
    places = [(i, j) for i in range(1, k + 1) for j in range(1, k + 1)]
    penalty = {(i, i): " + 1.0" for i in range(1, k)}
    for t in range(steps):
        at = " + ".join(f"b{i} * z{i}" for i in range(1, k + 1))
        sums = [f"sum(p * (1 - p) * z{i} * z{j}){penalty.get((i, j), '')}" for i, j in places]
        sums += [f"sum((p - y) * z{i}){'' if i == k else f' + any_value(b{i})'}" for i in range(1, k + 1)]
        rows_of = [i for i, _ in places] + list(range(1, k + 1))
        columns = [j for _, j in places] + [k + 1] * k
        parts.append(
            f"s{t}_0 as materialized (select unnest({rows_of}) as i, unnest({columns}) as j, unnest([{', '.join(sums)}]) as v "
            f"from (select *, 1 / (1 + exp(-({at}))) as p from z cross join b{t}))"
        )
        for n in range(1, k + 1):
            parts.append(
                f"s{t}_{n} as materialized (select e.i, e.j, case when e.i = {n} then r.v / p.v else e.v - c.v * r.v / p.v end as v from s{t}_{n - 1} e "
                f"join s{t}_{n - 1} r on r.i = {n} and r.j = e.j join s{t}_{n - 1} c on c.i = e.i and c.j = {n} join s{t}_{n - 1} p on p.i = {n} and p.j = {n})"
            )
        steps_of = ", ".join(f"any_value(b{i}) - max(v) filter (i = {i}) as b{i}" for i in range(1, k + 1))
        parts.append(f"b{t + 1} as materialized (select {steps_of} from s{t}_{k} cross join b{t} where j = {k + 1})")
    names = [*features, "intercept"]
    ends = " union all ".join(f"select '{f}' as feature, b{i + 1} as coefficient from b{steps}" for i, f in enumerate(names))
    return f"with {', '.join(parts)} {ends}"


oracle("train_newton", newton_sql(f"select * from ({MODEL_ROWS}) where week < {SPLIT_WEEK}", MODEL_FEATURES, "target_high_risk"), "coefficient")


def boosting_sql(rows: str, features: list[str], label: str, keys: list[str]) -> str:
    """Every tree and level spelled out: sums by node, feature and bin, the best cut of each node, the rows' way down."""
    o = FEW_TREES
    cut_list = ", ".join(
        f"list_sort(list_distinct(quantile_cont(cast({f} as double), [{', '.join(f'{i}::double / {o.bins}' for i in range(1, o.bins))}]))) as c{k}" for k, f in enumerate(features)
    )
    bin_list = ", ".join(f"len(list_filter(c{k}, lambda c: c <= cast({f} as double)))" for k, f in enumerate(features))
    text = " || '|' || ".join([f"cast({k} as varchar)" for k in keys] + [f"'{o.seed}'"])
    parts = [
        f"base as materialized ({rows})",
        f"cuts as materialized (select {cut_list} from base)",
        f"r0 as materialized (select cast({label} as double) as y, [{bin_list}] as bins, md5({text}) as key, {o.base_margin}::double as margin from base cross join cuts)",
    ]
    found = []
    for t in range(1, o.trees + 1):
        chosen = columns_of(t, features, o.column_share, o.seed)
        parts.append(
            f"d{t}_0 as materialized (select bins, p - y as g, p * (1 - p) as h, 1 as node from (select *, 1 / (1 + exp(-margin)) as p from r{t - 1}) "
            f"where cast(('0x' || substr(md5(key || '|{t}'), 1, 8)) as bigint) / 4294967296.0::double < {o.row_share})"
        )
        way = "1"
        for level in range(o.depth + 1):
            parts.append(f"n{t}_{level} as materialized (select node, sum(g) as g, sum(h) as h from d{t}_{level} where node >= {2**level} group by node)")
            if level == o.depth:
                break
            parts.append(
                f"s{t}_{level} as (select node, f, b, sum(g) as g, sum(h) as h from (select node, g, h, f, bins[f + 1] as b from d{t}_{level}, unnest({chosen}) as u(f) where node >= {2**level}) group by all)"
            )
            window = "over (partition by s.node, f order by b rows between unbounded preceding and 1 preceding)"
            parts.append(f"l{t}_{level} as (select s.node, f, b, n.g as tg, n.h as th, sum(s.g) {window} as gl, sum(s.h) {window} as hl from s{t}_{level} s join n{t}_{level} n using (node))")
            gain = f"gl * gl / (hl + {o.leaf_penalty}) + (tg - gl) * (tg - gl) / (th - hl + {o.leaf_penalty}) - tg * tg / (th + {o.leaf_penalty})"
            parts.append(
                f"b{t}_{level} as materialized (select * from (select *, row_number() over (partition by node order by round(gain, 9) desc, f, b) as place from "
                f"(select *, {gain} as gain from l{t}_{level} where gl is not null) where least(hl, th - hl) >= {o.least_hessian} and gain > {LEAST_GAIN}) where place = 1)"
            )
            parts.append(
                f"d{t}_{level + 1} as materialized (select bins, g, h, case when b.node is null then d.node when bins[f + 1] < b then 2 * d.node else 2 * d.node + 1 end as node "
                f"from (select bins, g, h, node from d{t}_{level}) d left join (select node, f, b from b{t}_{level}) b on b.node = d.node)"
            )
        nodes = " union all ".join(f"select {t} as tree, n.node, f, b, gain, n.h as cover, -{o.rate} * n.g / (n.h + {o.leaf_penalty}) as value from n{t}_{k} n left join b{t}_{k} b using (node)" for k in range(o.depth))
        nodes += f" union all select {t}, node, null, null, null, h, -{o.rate} * g / (h + {o.leaf_penalty}) from n{t}_{o.depth}"
        parts.append(f"t{t} as materialized ({nodes})")
        found.append(f"select * from t{t}")
        rows_at = f"(select *, 1 as node from r{t - 1})"
        for level in range(o.depth):
            rows_at = (
                f"(select r.* exclude (node), case when b.node is null then r.node when bins[f + 1] < b then 2 * r.node else 2 * r.node + 1 end as node "
                f"from {rows_at} r left join (select node, f, b from b{t}_{level}) b on b.node = r.node)"
            )
        parts.append(f"r{t} as materialized (select r.* exclude (node, margin), margin + value as margin from {rows_at} r join (select node, value from t{t}) using (node))")
    names = "[" + ", ".join(f"'{f}'" for f in features) + "]"
    all_cuts = "[" + ", ".join(f"c{k}" for k in range(len(features))) + "]"
    return f"""with {', '.join(parts)}
    select tree, node, {names}[f + 1] as feature, {all_cuts}[f + 1][b] as threshold, gain, cover, value from ({' union all '.join(found)}) cross join cuts"""


TREES = boosting_sql("select * from study", CLICK_FEATURES, "target", STUDY_KEY)
oracle("boosted_trees", TREES, "threshold, gain, cover, value")
oracle(
    "boosted_importance",
    f"""select feature, case when sum(g) over () > 0 then g / sum(g) over () else 0.0 end as importance, splits, row_number() over (order by g desc, feature) as rank from (
        select feature, coalesce(avg(gain), 0.0) as g, count(gain) as splits from (select unnest({CLICK_FEATURES}) as feature) left join ({TREES}) using (feature) group by 1)""",
    "importance",
)


def given_trees() -> str:
    """The two given trees as nested cases: value of the leaf, and change of value per feature on the way."""
    nodes = {(t, n): (f, x, left, v) for t, n, f, x, left, _, _, v in TWO_TREES}

    def walk(tree: int, n: int, of: str | None) -> str:
        f, x, left, value = nodes[tree, n]
        if f is None:
            return "0.0" if of else f"{value}::double"
        sides = []
        for child in (2 * n, 2 * n + 1):
            step = f"({nodes[tree, child][3]}::double - {value}::double) + " if of == f else ""
            sides.append(f"({step}{walk(tree, child, of)})")
        return f"case when coalesce({f} < {x}, {left}) then {sides[0]} else {sides[1]} end"

    columns = ", ".join(f"{walk(1, 1, f)} + {walk(2, 1, f)} as {f}" for f in TREE_FEATURES)
    return f"select {PANEL_KEY}, {walk(1, 1, None)} + {walk(2, 1, None)} as margin, {nodes[1, 1][3]}::double + ({nodes[2, 1][3]})::double as base, {columns} from panel"


oracle("tree_contributions", given_trees(), f"margin, base, {', '.join(TREE_FEATURES)}")

# ---- sources and sinks -------------------------------------------------------------------------

NOTE = """event_type || chr(10) || '"' || coalesce(props, '') || '", ' || coalesce(cast(user_id as varchar), '') || chr(10)"""
MALFORMED = "(event_id % 97 = 0 or event_id % 89 = 1)"
oracle("csv_multiline_scan", f"select cast(event_id as varchar) as event_id, {NOTE} as note, cast(cast(floor(value) as bigint) as varchar) as value from events where not {MALFORMED}")
oracle(
    "csv_rejects",
    f"""select 'wrong number of cells' as reason, event_id || ',"' || replace({NOTE}, '"', '""') || '"' ||
        case when event_id % 97 = 0 then '' else coalesce(',' || cast(floor(value) as bigint), '') || ',more' end as record from events where {MALFORMED}""",
)
oracle(
    "landing_audit",
    f"""select 'student_info' as "table", count(*) as rows, cast(0 as bigint) as rejects from student_info
    union all select 'student_assessment', count(*), 0 from student_assessment union all select 'assessments', count(*), 0 from assessments
    union all select 'student_vle', count(*), 0 from student_vle
    union all select 'events', count(*) filter (not {MALFORMED}), count(*) filter {MALFORMED.replace('(', '(where (', 1)}) from events""",
)
oracle("committed_latest_run", "select * from risk", RISK_DOUBLES)
oracle(
    "committed_history",
    f"""select case run_date when date '{RUN_DATE}' then 'r2' else 'r1' end as run_id, run_date, count(*) as rows,
        cast(sum(high_risk_flag) as bigint) as flagged, count(*) as logged from risk_runs group by run_date""",
)
oracle("incremental_panel", "select * from panel", PANEL_DOUBLES)
oracle(
    "risk_weekly_bucketed",
    "select * from risk_weekly",
    "risk_score, weekly_score_mean, rolling_3_week_mean, weekly_score_trend, studied_credits, pass_probability_base",
)
oracle(
    "generations_scan",
    """select event_id, user_id, case when event_id % 3 <> 0 then event_type end as event_type,
        case event_id % 3 when 0 then floor(value) when 2 then value end as value from events""",
    "value",
)
oracle(
    "heatmap_pivot",
    f"""select week, {', '.join(f"avg(high_risk_rate) filter (code_module = '{m}') as {m}" for m in HEATMAP_MODULES)}
    from summary where run_date = date '{RUN_DATE}' group by week""",
    ", ".join(HEATMAP_MODULES),
)

oracle("csv_scan", "select * from panel", PANEL_DOUBLES, events_default=EVENTS_RAW)
oracle(
    "load_audit",
    """select 'student_info' as "table", count(*) as rows from student_info union all select 'student_assessment', count(*) from student_assessment
    union all select 'assessments', count(*) from assessments union all select 'student_vle', count(*) from student_vle""",
)
oracle(
    "column_evolution",
    """select week, count(*) as rows, cast(sum(student_count) as bigint) as students
    from (select null::integer as week, student_count from summary union all select week, student_count from summary) group by 1""",
)
RUN_COUNTS = "select run_date, count(*) as rows, cast(sum(high_risk_flag) as bigint) as flagged from {} group by 1"
oracle("append_sink", RUN_COUNTS.format("(select * from risk_runs union all select * from risk)"))
oracle("partition_overwrite_sink", RUN_COUNTS.format("risk_runs"))
oracle(
    "mart_csv_sample",
    "select * from risk order by week, risk_score desc, id_student, code_module limit 500",
    RISK_DOUBLES,
)
oracle("assignment_csv", SCENARIOS, "risk_score, base_pass_prob, uplift_scenario, sim_pass_prob")
oracle("roi_csv", roi(COHORT), ROI_DOUBLES)
oracle("sql_chain_summary", "select * from summary_sql", "avg_risk_score")
oracle("snapshot_csv", "select id_student, code_module, week, risk_score from snap", "risk_score")
oracle(
    "artifact_manifest",
    """select * from (with files as (
        select 'rows_per_week' as report, 'week,rows' as line union all
        select 'rows_per_week', week || ',' || rows from (select week, count(*) as rows from risk group by week order by week limit 20) union all
        select 'target_counts', 'target,rows' union all select 'target_counts', target || ',' || count(*) from study group by target)
    select 'run-1' as run_id, report, cast(1 as bigint) as files, cast(sum(strlen(line) + 1) as bigint) as size_bytes from files group by report)""",
)


def declared() -> str:
    """The declared columns, with the values that two runs leave in the two filled tables."""
    filled = {"mart.student_risk_daily": "risk_runs", "mart.course_summary_daily": "summary"}
    rows = []
    for (namespace, table), ddl in OUTPUT_TABLES.items():
        name = f"{namespace}.{table}"
        for column in ddl.split(", "):
            c, kind = column.split(" ")
            count = f"(select count({c}) from {filled[name]})" if name in filled else "cast(0 as bigint)"
            rows.append(f"""select '{name}' as "table", '{c}' as "column", '{kind.lower()}' as type, {count} as filled""")
    return " union all ".join(rows)


oracle("output_tables", declared())
