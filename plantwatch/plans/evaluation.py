"""Evaluation queries: confusion, class report, ROC-AUC and alert quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantwatch.functions.labels import class_text
from plantwatch.operators import evaluation as V
from plantwatch.operators.rules import literal_rows
from plantwatch.plans.registry import query
from plantwatch.schema import PROBABILITY_THRESHOLD
from plantwatch.sources.adapters import table


def labelled_scores(spark, folder):
    """Events with label (error), score (value) and prediction (value above 100)."""
    return table(spark, folder, "events").select(
        "event_id",
        (F.col("event_type") == "error").cast("int").alias("label"),
        F.col("value").alias("score"),
        (F.col("value") > 100).cast("int").alias("prediction"),
        (F.col("user_id") % 6 + 1).cast("int").alias("stage"),
    )


def quality_pairs(spark, folder):
    return table(spark, folder, "labels").select(F.col("quality").alias("label"), (1 - F.col("toxic")).alias("prediction"))


_LABELLED = """labelled AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label, value AS score, CASE WHEN value > 100 THEN 1 ELSE 0 END AS prediction,
CAST(user_id % 6 + 1 AS INTEGER) AS stage FROM events)"""


@query("SELECT quality AS label, 1 - toxic AS prediction, count(*) AS n FROM labels GROUP BY 1, 2")
def confusion(spark, folder):
    return V.confusion(quality_pairs(spark, folder), "label", "prediction")


_REPORT = """classes AS (SELECT {g} c AS class, count(*) FILTER (WHERE label = c) AS support, count(*) FILTER (WHERE prediction = c) AS predicted,
count(*) FILTER (WHERE label = c AND prediction = c) AS hits, count(*) AS n FROM {t}, (SELECT unnest([0, 1]) AS c) cs GROUP BY ALL), present AS (
SELECT * FROM classes WHERE support + predicted > 0), rated AS (
SELECT *, coalesce(hits / nullif(predicted, 0), 0.0) AS p, coalesce(hits / nullif(support, 0), 0.0) AS r FROM present), scored AS (
SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f FROM rated)"""


@query(f"""WITH pairs AS (SELECT quality AS label, 1 - toxic AS prediction FROM labels), {_REPORT.format(g='', t='pairs')}
SELECT CAST(class AS VARCHAR) AS class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM scored
UNION ALL SELECT 'accuracy', round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6), sum(support)::BIGINT FROM scored
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), sum(support)::BIGINT FROM scored
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6), sum(support)::BIGINT FROM scored""")
def class_report(spark, folder):
    report = V.class_report(quality_pairs(spark, folder), "label", "prediction")
    return report.withColumns({m: F.round(m, 6) for m in ("precision", "recall", "f1")})


@query(f"""WITH {_LABELLED}, scores AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM labelled GROUP BY score), ranked AS (
SELECT *, sum(neg) OVER (ORDER BY score) AS upto FROM scores)
SELECT round((sum(pos * (upto - neg / 2)) / (sum(pos) * sum(neg)))::DOUBLE, 8) AS roc_auc FROM ranked""")
def roc_auc(spark, folder):
    return V.roc_auc(labelled_scores(spark, folder), "label", "score").select(F.round("roc_auc", 8).alias("roc_auc"))


@query(f"""WITH {_LABELLED}, tested AS (SELECT stage, label, 'random_forest' AS model, prediction FROM labelled
UNION ALL SELECT stage, label, 'isolation_forest', CASE WHEN score > 150 THEN 1 ELSE 0 END FROM labelled), {_REPORT.format(g='stage, model,', t='tested')}
SELECT stage, model, round(sum(hits) / sum(support), 6) AS accuracy, round(sum(f * support) / sum(support), 6) AS weighted_f1 FROM scored GROUP BY 1, 2""")
def feature_model_report(spark, folder):
    models = F.array(
        F.struct(F.lit("random_forest").alias("model"), F.col("prediction").alias("predicted")),
        F.struct(F.lit("isolation_forest").alias("model"), (F.col("score") > 150).cast("int").alias("predicted")),
    )
    tested = labelled_scores(spark, folder).select("stage", "label", F.inline(models))
    summary = V.model_summary(tested, "label", "predicted", ["stage", "model"])
    return summary.withColumns({m: F.round(m, 6) for m in ("accuracy", "weighted_f1")})


@query(f"""WITH {_LABELLED}, shown(measure, shown_percent) AS (VALUES ('precision', 12.91), ('recall', 92.07)), q AS (
SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS h, count(*) FILTER (WHERE prediction = 1) AS a, count(*) FILTER (WHERE label = 1) AS t FROM labelled)
SELECT measure, CAST(shown_percent AS DOUBLE) AS shown_percent, round(CASE measure WHEN 'precision' THEN coalesce(h / nullif(a, 0), 0) ELSE coalesce(h / nullif(t, 0), 0) END * 100, 6) AS measured_percent FROM shown, q""")
def alert_quality(spark, folder):
    """Measured precision and recall of the alerts beside the two fixed figures a panel displays."""
    shown = literal_rows(spark, [
        {"measure": "precision", "shown_percent": 12.91},
        {"measure": "recall", "shown_percent": 92.07},
    ])
    measured = V.alert_quality(labelled_scores(spark, folder), "label", "prediction").unpivot(
        [], ["precision_percent", "recall_percent"], "name", "measured_percent"
    ).select(F.regexp_replace("name", "_percent", "").alias("measure"), F.round("measured_percent", 6).alias("measured_percent"))
    return shown.join(measured, "measure")


@query(f"""WITH {_LABELLED} SELECT event_id, score / 500 > 0.07 AS is_anomaly, CASE WHEN prediction = 1 THEN 'Attack' ELSE 'Normal' END AS prediction_label FROM labelled""")
def decision_columns(spark, folder):
    rows = labelled_scores(spark, folder).withColumn("probability", F.col("score") / 500)
    return V.decided(rows, "probability", "prediction", PROBABILITY_THRESHOLD).select("event_id", "is_anomaly", "prediction_label")


@query(f"""WITH {_LABELLED} SELECT CASE WHEN label = 1 THEN 'Attack' ELSE 'Normal' END AS label_text, CASE WHEN score / 500 > 0.07 THEN 'Attack' ELSE 'Normal' END AS by_threshold,
CASE WHEN prediction = 1 THEN 'Attack' ELSE 'Normal' END AS by_class, count(*) AS n, round(avg(score), 6) AS mean_score FROM labelled GROUP BY 1, 2, 3""")
def evaluation_summary(spark, folder):
    rows = labelled_scores(spark, folder)
    over = (F.col("score") / 500 > PROBABILITY_THRESHOLD).cast("int")
    return rows.groupBy(
        class_text(F.col("label")).alias("label_text"), class_text(over).alias("by_threshold"), class_text(F.col("prediction")).alias("by_class")
    ).agg(F.count("*").alias("n"), F.round(F.avg("score"), 6).alias("mean_score"))


@query("""WITH l AS (SELECT vec_id, label, embedding[1]::DOUBLE AS s0, embedding[2]::DOUBLE AS s1, embedding[3]::DOUBLE AS s2 FROM embeddings), o AS (
SELECT '0' AS class, CASE WHEN label = 0 THEN 1 ELSE 0 END AS y, s0 AS s FROM l UNION ALL SELECT '1', CASE WHEN label = 1 THEN 1 ELSE 0 END, s1 FROM l UNION ALL SELECT '2', CASE WHEN label = 2 THEN 1 ELSE 0 END, s2 FROM l), g AS (
SELECT class, s, sum(y) AS pos, sum(1 - y) AS neg FROM o GROUP BY 1, 2), r AS (SELECT *, sum(neg) OVER (PARTITION BY class ORDER BY s) AS upto FROM g)
SELECT class, round((sum(pos * (upto - neg / 2)) / (sum(pos) * sum(neg)))::DOUBLE, 8) AS roc_auc FROM r GROUP BY class""")
def roc_auc_by_class(spark, folder):
    rows = table(spark, folder, "embeddings").select(
        F.col("label").cast("string").alias("label"), *[F.col("embedding")[i].cast("double").alias(f"s{i}") for i in range(3)]
    )
    auc = V.roc_auc_by_class(rows, "label", {"0": "s0", "1": "s1", "2": "s2"})
    return auc.select("class", F.round("roc_auc", 8).alias("roc_auc"))


@query("""WITH o AS (SELECT c AS class, CASE WHEN label = c THEN 1 ELSE 0 END AS y, embedding[c + 1]::DOUBLE AS s FROM embeddings, (SELECT unnest(range(10)) AS c) cs), g AS (
SELECT class, s, sum(y) AS pos, sum(1 - y) AS neg FROM o GROUP BY 1, 2), r AS (SELECT *, sum(neg) OVER (PARTITION BY class ORDER BY s) AS upto FROM g), a AS (
SELECT class, (sum(pos * (upto - neg / 2)) / (sum(pos) * sum(neg)))::DOUBLE AS auc FROM r GROUP BY class)
SELECT CAST(class AS VARCHAR) AS class, round(auc, 8) AS roc_auc FROM a UNION ALL SELECT 'macro', round(avg(auc), 8) FROM a""")
def roc_auc_all_classes(spark, folder):
    """One-vs-rest areas of all ten classes and their mean."""
    names = [str(i) for i in range(10)]
    rows = table(spark, folder, "embeddings").select(
        F.col("label").cast("string").alias("label"), *[F.col("embedding")[int(n)].cast("double").alias(f"s{n}") for n in names]
    )
    areas = V.roc_auc_by_class(rows, "label", {n: f"s{n}" for n in names})
    macro = V.macro_auc(areas).select(F.lit("macro").alias("class"), F.col("macro_auc").alias("roc_auc"))
    return areas.unionByName(macro).select("class", F.round("roc_auc", 8).alias("roc_auc"))
