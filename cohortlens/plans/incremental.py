"""The weekly panel, fed batch by batch.

A batch of submissions is summed per student and week; its panel rows follow from these sums and from a carry row per student and
module: the submissions so far, the last week, and the means of the last two rows. That is all that running total, rolling
mean of three and change need of the past, so a batch of new weeks reads the carry and itself, and no older partition.

A late row, of a week that its student has already passed, re-opens the student: the stored sums of that student (only) are read
again and the rows from that week on are written anew. Nothing is changed in place: ``reopened`` says from
which week on older rows of a student no longer count, and readers leave those out. Each batch is one run of the commit log: a rerun of the
last batch takes its place, a batch that died was never there.

Attributes come from the info table given with each batch; a row has those of the batch that wrote it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.operators.events import dated_submissions
from cohortlens.operators.weekly import by_week, change, rolling_mean, running_total, with_target
from cohortlens.schemas import ATTRIBUTES
from cohortlens.sources.commits import Run, committed, read_runs

SUMS = "id_student BIGINT, week INT, score_sum DOUBLE, score_count BIGINT, submitted BIGINT"
CARRY = "id_student BIGINT, code_module STRING, last_week INT, total BIGINT, mean_1 DOUBLE, mean_2 DOUBLE, weeks BIGINT"
REOPENED = "id_student BIGINT, from_week INT"
KEY = ["id_student", "code_module"]


def _info(student_info: DataFrame) -> DataFrame:
    keyed = student_info.where("id_student IS NOT NULL AND code_module IS NOT NULL")
    return keyed.groupBy(KEY).agg(F.count(F.lit(1)).alias("copies"), *[F.max(c).alias(c) for c in ATTRIBUTES])


def _weekly(sums: DataFrame, info: DataFrame) -> DataFrame:
    means = sums.selectExpr("id_student", "week", "score_sum / nullif(score_count, 0) AS weekly_score_mean", "submitted")
    rows = means.join(info, "id_student")
    return rows.select(*KEY, "week", "weekly_score_mean", (F.col("submitted") * F.col("copies")).alias("weekly_submissions"), *ATTRIBUTES)


def _from_carry(carry: DataFrame) -> DataFrame:
    """The carry as rows before the new ones: the last two means, with all submissions so far on the last."""
    one = F.struct(F.lit(-1).alias("back"), F.col("mean_1").alias("weekly_score_mean"), F.col("total").alias("weekly_submissions"))
    two = F.struct(F.lit(-2).alias("back"), F.col("mean_2").alias("weekly_score_mean"), F.lit(0).cast("bigint").alias("weekly_submissions"))
    both = F.when(F.col("weeks") > 1, F.array(two, one)).otherwise(F.array(one))
    rows = carry.select(*KEY, "last_week", "weeks", F.explode(both).alias("r"))
    return rows.select(*KEY, (F.col("last_week") + F.col("r.back") + 1).alias("week"), "r.weekly_score_mean", "r.weekly_submissions", F.col("weeks").alias("past"))


def _history(rows: DataFrame) -> DataFrame:
    """Panel columns, and the carry after each row. ``past`` (rows that went before) is null for rows of the panel."""
    rows = rows.withColumns(
        {
            "cum_submissions": running_total("weekly_submissions"),
            "rolling_score_3w": rolling_mean("weekly_score_mean"),
            "score_trend_2w": F.coalesce(change("weekly_score_mean"), F.lit(0.0)),
            "before": F.lag("weekly_score_mean").over(by_week()),
            # the carry's rows say how many there were; they stand first
            "weeks": F.coalesce(F.max("past").over(W.partitionBy(KEY)), F.lit(0)) + F.count_if(F.col("past").isNull()).over(by_week()),
        }
    )
    return rows.where("past IS NULL").drop("past")


def _last(history: DataFrame) -> DataFrame:
    """The carry: of each key the row of its last week."""
    value = F.struct("week", F.col("cum_submissions").alias("total"), F.col("weekly_score_mean").alias("mean_1"), F.col("before").alias("mean_2"), "weeks")
    rows = history.groupBy(KEY).agg(F.max_by(value, "week").alias("v"))
    return rows.select(*KEY, F.col("v.week").alias("last_week"), "v.total", "v.mean_1", "v.mean_2", "v.weeks")


def panel_schema(student_info: DataFrame) -> str:
    kinds = dict(student_info.dtypes)
    attributes = ", ".join(f"{c} {kinds[c]}" for c in ATTRIBUTES)
    return (
        f"id_student BIGINT, code_module STRING, week INT, weekly_score_mean DOUBLE, weekly_submissions BIGINT, {attributes}, cum_submissions BIGINT, "
        "rolling_score_3w DOUBLE, score_trend_2w DOUBLE, dropout_risk_target DOUBLE, target_high_risk INT"
    )


def add_batch(spark: SparkSession, root: str, batch: str, run_date: str, submissions: DataFrame, student_info: DataFrame, assessments: DataFrame) -> None:
    """Add a batch; batches are named in ascending order. Only the last one may be run again."""
    run = Run(spark, root, batch, run_date)
    done = sorted(r.run_id for r in committed(spark, root).select("run_id").distinct().collect())
    if done and batch < done[-1]:
        raise ValueError(f"batch {batch} comes before {done[-1]}, which is there already")
    before = [b for b in done if b < batch]
    dated = dated_submissions(submissions, assessments).where("id_student IS NOT NULL")
    sums = run.write(
        "sums",
        dated.groupBy("id_student", "week").agg(
            F.sum("score").alias("score_sum"), F.count("score").alias("score_count"), F.sum("submitted").cast("bigint").alias("submitted")
        ),
    )
    carry = read_runs(spark, root, "carry", CARRY, before[-1:]).drop("run_id")
    info = _info(student_info)
    last = carry.groupBy("id_student").agg(F.max("last_week").alias("last_week"))
    late = sums.join(last, "id_student").where("week <= last_week").groupBy("id_student").agg(F.min("week").alias("from_week"))
    late = run.write("reopened", late)
    on_time = sums.join(late, "id_student", "left_anti")
    new = _weekly(on_time, info)
    seeds = _from_carry(carry.join(new.select(KEY).distinct(), KEY, "left_semi"))
    history = _history(new.withColumn("past", F.lit(None).cast("bigint")).unionByName(seeds, allowMissingColumns=True))
    if not late.isEmpty():
        # all sums of the re-opened students, of this batch and of those before
        every = read_runs(spark, root, "sums", SUMS, before).drop("run_id").unionByName(sums).join(late.select("id_student"), "id_student", "left_semi")
        again = every.groupBy("id_student", "week").agg(F.sum("score_sum").alias("score_sum"), F.sum("score_count").alias("score_count"), F.sum("submitted").alias("submitted"))
        history = history.unionByName(_history(_weekly(again, info).withColumn("past", F.lit(None).cast("bigint"))))
    # read twice: for the panel and for the carry
    history = run.write("history", history)
    fresh = history.join(late, "id_student", "left").where("from_week IS NULL OR week >= from_week").drop("from_week", "before", "weeks")
    run.write("panel", with_target(fresh).select(*[f.split(" ")[0] for f in panel_schema(student_info).split(", ")]))
    changed = _last(history)
    run.write("carry", carry.join(changed, KEY, "left_anti").unionByName(changed))
    run.commit()


def read_panel(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The panel of all batches: rows that a later batch wrote anew are left out."""
    rows = read_runs(spark, root, "panel", schema)
    gone = read_runs(spark, root, "reopened", REOPENED).select(F.col("id_student").alias("r_student"), "from_week", F.col("run_id").alias("r_run"))
    older = (F.col("id_student") == F.col("r_student")) & (F.col("week") >= F.col("from_week")) & (F.col("run_id") < F.col("r_run"))
    return rows.join(gone, older, "left_anti").drop("run_id")
