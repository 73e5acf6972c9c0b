"""Registered queries: trajectory features, labels and models (M1–M6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardpulse.functions.clinical import clinical_state
from wardpulse.operators import trajectory as M
from wardpulse.operators.windows import DOUBLE_PLACES
from wardpulse.plans.oracle import sql
from wardpulse.plans.q_scoring import _CLIN_SQL
from wardpulse.plans.registry import register, scored


def _features_sql() -> str:
    cols = ["seq", "patient_id", "ts_ms", "news2_score", "news2_tier", *M.FEATURE_VITALS,
            "count(*) OVER w AS n"]
    x = f"(ts_ms - {M.DAY0_MS}) / 60000.0::DOUBLE"
    for v, s in M.FEATURE_VITALS.items():
        if v == "temperature":
            cols.append(f"round(avg(CASE WHEN NOT isnan({v}) THEN {v} END) OVER w, "
                        f"{DOUBLE_PLACES}) AS {s}_mean")
        else:
            cols.append(f"avg({v}) OVER w AS {s}_mean")
        cols += [f"round(stddev_samp({v}) OVER w, 4) AS {s}_std",
                 f"CASE WHEN var_pop({x}) OVER w = 0 THEN NULL "
                 f"ELSE round(regr_slope({v}, {x}) OVER w, 4) END AS {s}_slope",
                 f"{v} - arg_min({v}, (ts_ms, seq)) OVER w AS {s}_delta"]
    return ("SELECT " + ",\n  ".join(cols) + "\nFROM scored WINDOW w AS (PARTITION BY "
            f"patient_id ORDER BY ts_ms RANGE BETWEEN {M.WINDOW_MS} PRECEDING AND CURRENT ROW)")


@register("trajectory_features", sql(_features_sql()))
def trajectory_features(spark, sf_dir):
    """M1: trailing 10-minute slope/delta/mean/std per vital, per reading."""
    return M.trajectory_features(scored(spark, sf_dir))


@register("deterioration_label", sql(f"""
SELECT seq, patient_id, ts_ms, label FROM (
  SELECT seq, patient_id, ts_ms, news2_tier,
    CAST(coalesce(max(CAST(news2_tier = 'High' AS INTEGER)) OVER (
      PARTITION BY patient_id ORDER BY ts_ms
      RANGE BETWEEN 1 FOLLOWING AND {M.HORIZON_MS} FOLLOWING), 0) AS INTEGER) AS label
  FROM scored)
WHERE news2_tier <> 'High'"""))
def deterioration_label(spark, sf_dir):
    """M2: reaches High within the next 10 minutes (not already High)."""
    return M.deterioration_label(scored(spark, sf_dir))


@register("state_confusion", sql(f"""
SELECT simulator_state, {_CLIN_SQL} AS predicted_state, count(*) AS readings
FROM raw GROUP BY ALL"""))
def state_confusion(spark, sf_dir):
    """M4: confusion of the rule classifier (F17) against ground truth."""
    return (scored(spark, sf_dir)
            .groupBy("simulator_state", clinical_state().alias("predicted_state"))
            .agg(F.count(F.lit(1)).alias("readings")))


@register("lead_time", sql(f"""
, feats AS ({_features_sql()}),
sf AS (SELECT *, coalesce(max(CASE WHEN news2_tier = 'High' THEN seq END) OVER (
         PARTITION BY patient_id ORDER BY seq ROWS UNBOUNDED PRECEDING), -1) AS after_seq
       FROM feats),
ff AS (SELECT patient_id, after_seq, min(ts_ms) AS first_flag_ms FROM sf
       WHERE hr_slope >= {M.TREND_SLOPE} AND n >= {M.TREND_MIN_READINGS}
         AND news2_tier <> 'High' GROUP BY ALL),
fh AS (SELECT patient_id, coalesce(lag(seq) OVER (PARTITION BY patient_id ORDER BY seq), -1)
         AS after_seq, ts_ms AS high_ms FROM feats WHERE news2_tier = 'High')
SELECT ff.patient_id, ff.after_seq, first_flag_ms, high_ms, high_ms - first_flag_ms AS lead_ms
FROM ff JOIN fh ON ff.patient_id = fh.patient_id AND ff.after_seq = fh.after_seq"""))
def lead_time(spark, sf_dir):
    """M6: per High onset, lead time from the first heart-rate trend flag."""
    return M.lead_time(M.trajectory_features(scored(spark, sf_dir))).select(
        "patient_id", "after_seq", "first_flag_ms", "high_ms", "lead_ms")


def _train_and_predict(spark, sf_dir):
    frame = M.training_frame(scored(spark, sf_dir))
    ckpt = frame.checkpoint()          # cut lineage: features feed fit and predict
    model = M.fit_model(ckpt.filter("is_train"))
    return M.predict(model, ckpt.filter(~F.col("is_train")))


@register("ml_train_predict")
def ml_train_predict(spark, sf_dir):
    """M3/M5: logistic regression on trajectory features, split by patient;
    predictions for the held-out patients (model output: rows-only check)."""
    from wardpulse.session import shared_dir
    shared_dir(spark)
    return _train_and_predict(spark, sf_dir).select(
        "seq", "patient_id", "label", "prediction", "p_deteriorate")


@register("ml_holdout", sql(f"""
SELECT seq, patient_id, CAST(label AS DOUBLE) AS label FROM (
  SELECT seq, patient_id, news2_tier,
    coalesce(max(CAST(news2_tier = 'High' AS INTEGER)) OVER (
      PARTITION BY patient_id ORDER BY ts_ms
      RANGE BETWEEN 1 FOLLOWING AND {M.HORIZON_MS} FOLLOWING), 0) AS label
  FROM scored)
WHERE news2_tier <> 'High'
  AND CAST('0x' || substr(md5(patient_id), 1, 6) AS BIGINT) % 10 >= {M.TRAIN_BUCKETS}"""))
def ml_holdout(spark, sf_dir):
    """M3/M5: the held-out rows and labels that the model is scored on."""
    return (M.training_frame(scored(spark, sf_dir)).filter(~F.col("is_train"))
            .select("seq", "patient_id", "label"))


@register("ml_state_confusion")
def ml_state_confusion(spark, sf_dir):
    """M4: the model's predictions against the ground-truth state."""
    from wardpulse.session import shared_dir
    shared_dir(spark)
    return M.state_confusion_of(_train_and_predict(spark, sf_dir), scored(spark, sf_dir))


@register("ml_eval")
def ml_eval(spark, sf_dir):
    """M4: AUC of the model on held-out patients (rows-only check)."""
    from wardpulse.session import shared_dir
    shared_dir(spark)
    return M.evaluate(_train_and_predict(spark, sf_dir))
