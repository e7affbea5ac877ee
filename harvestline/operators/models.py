"""Model operators (ML1–ML12, SRT5) on Spark ML.

* features are Column expressions, assembled with ``VectorAssembler``;
* a model reads its rows once: equal feature rows are counted (by split and
  fold) and stored, and statistics, fits, metrics and folds weigh what was
  stored by the counts, so that a step costs what the distinct rows cost;
* standardisation uses the **population** std from one aggregate pass
  (``StandardScaler`` would use the sample std), constant columns → 0;
* the train/test split and the CV folds hash a row key, so they do not
  change when the data is repartitioned (``randomSplit`` would);
* L2 logistic regression with ``C = 1`` in the usual ``½‖w‖² + C·Σloss``
  form is ``regParam = 1/n`` in Spark's ``(1/n)·Σloss + ½·λ‖w‖²`` form;
* metrics are one aggregate over tp/tn/fp/fn; nothing is collected except
  the model coefficients (one number per feature).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import half_up_div
from ..sources.tables import scratch_table

EPS_STD = 1e-8
EPS_LOG = 1e-15
TRAIN_PCT = 80


def standardise(df: DataFrame, features) -> DataFrame:
    """(x − mean) / (population std + 1e-8), statistics from one row broadcast back (ML3)."""
    stats = df.agg(*[F.avg(c).alias(f"_m_{c}") for c in features],
                   *[F.stddev_pop(c).alias(f"_s_{c}") for c in features])
    j = df.crossJoin(F.broadcast(stats))
    return j.withColumns({c: (F.col(c) - F.col(f"_m_{c}")) / (F.coalesce(F.col(f"_s_{c}"), F.lit(0.0)) + EPS_STD)
                          for c in features}).drop(*[f"_m_{c}" for c in features], *[f"_s_{c}" for c in features])


def standardise_counted(rows: DataFrame, features) -> DataFrame:
    """``standardise`` where a row counts ``n`` times (ML3); a constant column is 0."""
    n = F.sum("n")
    first = rows.agg(n.alias("n"), *[f(c).alias(f"{k}_{c}") for c in features for k, f in (("lo", F.min), ("hi", F.max))],
                     *[(F.sum(F.col(c) * F.col("n")) / F.sum(F.when(F.col(c).isNotNull(), F.col("n")))).alias(f"m_{c}") for c in features]).first()
    mean = {c: F.lit(first[f"m_{c}"]).cast("double") for c in features}
    second = rows.agg(n.alias("n"), *[F.sqrt(F.sum((F.col(c) - mean[c]) * (F.col(c) - mean[c]) * F.col("n")) / F.sum(F.when(F.col(c).isNotNull(), F.col("n")))).alias(c)
                                      for c in features]).first()
    return rows.withColumns({c: F.when(F.col(c).isNotNull(), F.lit(0.0)) if first[f"lo_{c}"] == first[f"hi_{c}"]
                             else (F.col(c) - mean[c]) / (F.lit(second[c] or 0.0) + EPS_STD) for c in features})


def hash_bucket(keys, seed: int = 42, buckets: int = 100):
    """Stable bucket in [0, buckets) from the row key (ML4)."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(buckets))


def split(df: DataFrame, keys, train_pct: int = TRAIN_PCT, seed: int = 42):
    """80/20 split by key hash (ML4)."""
    b = hash_bucket(keys, seed)
    return df.filter(b < train_pct), df.filter(b >= train_pct)


def fold_of(keys, folds: int = 5, seed: int = 7):
    """Fold in [0, folds) from the row key (ML10)."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(folds)).cast("int")


def count_rows(df: DataFrame, features, label: str, keys, folds: int = 5) -> DataFrame:
    """The distinct rows of features and label with how many rows they stand for:
    ``n``, of these ``train`` by the split (ML4) and ``fold_0`` ... by fold (ML10).

    Stored, so that the many steps of a fit start from files; as many rows as
    before where none are equal."""
    marked = df.select(*features, label, (hash_bucket(keys) < TRAIN_PCT).alias("_train"), fold_of(keys, folds).alias("_fold"))
    return scratch_table(marked.groupBy(*features, label).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("_train").alias("train"),
        *[F.count_if(F.col("_fold") == k).alias(f"fold_{k}") for k in range(folds)]), "counted")


def fit_logit(train: DataFrame, features, label: str, c: float = 1.0, max_iter: int = 1000, weight: str | None = None):
    """L2 logistic regression equivalent to C = ``c`` (ML5); a row counts ``weight`` times."""
    n = train.agg(F.sum(weight)).first()[0] or 0 if weight else train.count()
    assembled = VectorAssembler(inputCols=list(features), outputCol="features").transform(train)
    lr = LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter,
                            regParam=1.0 / (c * max(n, 1)), elasticNetParam=0.0, standardization=False)
    return (lr.setWeightCol(weight) if weight else lr).fit(assembled)


def predict(model, df: DataFrame, features, threshold: float = 0.5) -> DataFrame:
    """Probability of the positive class and the 0/1 prediction (ML6)."""
    a = VectorAssembler(inputCols=list(features), outputCol="features").transform(df)
    p = model.transform(a).withColumn("prob", vector_to_array("probability")[1])
    return p.withColumn("pred", (F.col("prob") >= threshold).cast("int")).drop("features", "rawPrediction",
                                                                                 "probability", "prediction")


def _ratio4(num, den):
    return F.when(den > 0, half_up_div(num * 10000, den) / 10000.0).otherwise(F.lit(0.0))


def binary_metrics(df: DataFrame, label: str = "label", pred: str = "pred", weight: str | None = None) -> DataFrame:
    """Accuracy, precision, recall, F1 (0 when a denominator is 0) and the
    confusion counts from one aggregate (ML7, ML8); a row counts ``weight`` times."""
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    w = F.col(weight) if weight else F.lit(1).cast("long")
    g = df.agg(F.sum(((y == 1) & (p == 1)).cast("long") * w).alias("tp"),
               F.sum(((y == 0) & (p == 0)).cast("long") * w).alias("tn"),
               F.sum(((y == 0) & (p == 1)).cast("long") * w).alias("fp"),
               F.sum(((y == 1) & (p == 0)).cast("long") * w).alias("fn"))
    tp, tn, fp, fn = (F.coalesce(F.col(c), F.lit(0)) for c in ("tp", "tn", "fp", "fn"))
    n = tp + tn + fp + fn
    return g.select(
        _ratio4(tp + tn, n).alias("accuracy"), _ratio4(tp, tp + fp).alias("precision"),
        _ratio4(tp, tp + fn).alias("recall"), _ratio4(tp * 2, tp * 2 + fp + fn).alias("f1"),
        tp.alias("tp"), tn.alias("tn"), fp.alias("fp"), fn.alias("fn"))


def confusion(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Counts per (label, prediction) (ML8)."""
    return df.groupBy(F.col(label).cast("int").alias("label"), F.col(pred).cast("int").alias("pred")).count()


def mcfadden(df: DataFrame, label: str = "label", prob: str = "prob", weight: str | None = None) -> DataFrame:
    """McFadden pseudo-R² with ε = 1e-15 in one aggregate (ML9); a row counts ``weight`` times."""
    y, p = F.col(label).cast("double"), F.col(prob)
    w = F.col(weight) if weight else F.lit(1).cast("long")
    ll = y * F.log(p + EPS_LOG) + (1 - y) * F.log(1 - p + EPS_LOG)
    mean = F.try_divide(F.sum(y * w), F.sum(F.when(y.isNotNull(), w)))
    g = df.agg(F.sum(ll * w).alias("ll"), mean.alias("pn"), F.coalesce(F.sum(w), F.lit(0)).alias("n"))
    ll_null = F.col("n") * (F.col("pn") * F.log(F.col("pn") + EPS_LOG)
                            + (1 - F.col("pn")) * F.log(1 - F.col("pn") + EPS_LOG))
    return g.select(F.round(1 - F.col("ll") / ll_null, 4).alias("mcfadden_r2"))


def _newton_sums(weights: np.ndarray, features: list, label: str):
    """Gradient, Hessian and loss of every fold's model (trained on the rows of the
    other folds), summed over a batch: a row a number, with its place."""
    folds = len(weights)

    def run(batches):
        for batch in batches:
            col = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
            x, y, n = np.column_stack([*map(col, features), np.ones(batch.num_rows)]), col(label), col("n")
            sums = []
            for k in range(folds):
                own, margin = n - col(f"fold_{k}"), x @ weights[k]
                p = 1 / (1 + np.exp(-np.clip(margin, -35, 35)))
                sums += [x.T @ (own * (p - y)), ((x * (own * p * (1 - p))[:, None]).T @ x).ravel(), [own @ (np.logaddexp(0, margin) - y * margin)]]
            flat = np.concatenate(sums)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["at", "v"])
    return run


def fit_counted(rows: DataFrame, features, label: str, folds: int, c: float = 1.0, max_iter: int = 100, tol: float = 1e-8) -> np.ndarray:
    """L2 logistic regressions (C = ``c``) of all folds at once over counted rows, one row
    of weights and intercept a fold, by Newton steps: a step is one pass over ``rows`` and
    one small aggregate for all folds.  A step that does not lessen its fold's loss
    is halved, so their number does not follow how large the weights become."""
    features = list(features)
    d = len(features) + 1
    weights, ridge = np.zeros((folds, d)), np.diag([1.0 / c] * (d - 1) + [1e-9])
    steps, reached, done = np.zeros((folds, d)), np.full(folds, np.inf), np.zeros(folds, bool)
    rows = rows.select(*[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("double").alias(label),
                       *[F.col(n).cast("double").alias(n) for n in ("n", *(f"fold_{k}" for k in range(folds)))])
    for _ in range(max_iter):
        sums = rows.mapInArrow(_newton_sums(weights, features, label), "at int, v double").groupBy("at").agg(F.sum("v").alias("v"))
        flat = np.zeros(folds * (d + d * d + 1))
        for r in sums.collect():  # d + d * d + 1 numbers a fold
            flat[r["at"]] = r["v"]
        for k, own in enumerate(flat.reshape(folds, -1)):
            if done[k]:
                continue
            loss = own[-1] + weights[k] @ ridge @ weights[k] / 2
            if loss > reached[k] + 1e-10 * abs(reached[k]):  # back by half of the step
                steps[k] /= 2
                weights[k] += steps[k]
            else:
                reached[k] = loss
                steps[k] = np.linalg.solve(own[d:-1].reshape(d, d) + ridge, own[:d] + ridge @ weights[k])
                weights[k] -= steps[k]
            done[k] = np.abs(steps[k]).max() < tol * max(1.0, np.abs(weights[k]).max())
        if done.all():
            break
    return weights


def fit_folds(df: DataFrame, features, label: str, folds: int, c: float = 1.0) -> np.ndarray:
    """The regressions of ``fit_counted`` over rows with their ``fold``."""
    return fit_counted(df.withColumns({"n": F.lit(1), **{f"fold_{k}": (F.col("fold") == k).cast("int") for k in range(folds)}}), features, label, folds, c)


def cv_f1_counted(rows: DataFrame, features, label: str, folds: int = 5) -> float:
    """Mean F1 over folds (ML10) of counted rows: the models of all folds are fitted
    together and judged by one aggregate; the data never leaves the executors."""
    weights = fit_counted(rows, features, label, folds)
    positive = F.col(label) > 0
    counts = []
    for k, w in enumerate(weights):
        pred = sum((F.col(f) * float(v) for f, v in zip(features, w)), F.lit(float(w[-1]))) >= 0
        counts += [F.coalesce(F.sum(F.when(c, F.col(f"fold_{k}"))), F.lit(0)).alias(f"{n}_{k}")
                   for n, c in (("tp", positive & pred), ("fp", ~positive & pred), ("fn", positive & ~pred))]
    g = rows.agg(*counts)
    tp, fp, fn = ([F.col(f"{n}_{k}") for k in range(folds)] for n in ("tp", "fp", "fn"))
    scores = g.select(*[_ratio4(a * 2, a * 2 + b + c) for a, b, c in zip(tp, fp, fn)]).first()  # one row
    return round(sum(scores) / folds, 4)


def cv_f1(df: DataFrame, features, label: str, keys, folds: int = 5) -> float:
    """``cv_f1_counted`` over rows, with folds by key."""
    return cv_f1_counted(count_rows(df, features, label, keys, folds), features, label, folds)


def coef_table(spark, model, features) -> DataFrame:
    """Coefficients ranked by magnitude with their direction (ML11, SRT5).
    One row per feature: a driver-side list of the fitted weights."""
    rows = [(f, float(c)) for f, c in zip(features, model.coefficients.toArray())]
    df = spark.createDataFrame(rows, "feature string, coefficient double")
    return (df.withColumn("direction", F.when(F.col("coefficient") >= 0, "+").otherwise("-"))
              .orderBy(F.abs("coefficient").desc()))


def weight_alignment(coefs: DataFrame, designed: dict) -> DataFrame:
    """Learned share of |coef| vs designed weight: < .10 Good, < .20 Off,
    else Divergent (ML12).  The total is a one-row aggregate broadcast back."""
    tot = coefs.agg(F.sum(F.abs("coefficient")).alias("_t"))
    d = F.create_map(*[x for k, v in designed.items() for x in (F.lit(k), F.lit(float(v)))])
    j = coefs.crossJoin(F.broadcast(tot))
    share = F.when(F.col("_t") > 0, F.abs("coefficient") / F.col("_t")).otherwise(0.0)
    diff = F.abs(share - F.coalesce(d[F.col("feature")], F.lit(0.0)))
    return (j.select("feature", "coefficient", F.round(share, 4).alias("learned_share"),
                     F.coalesce(d[F.col("feature")], F.lit(0.0)).alias("designed"),
                     F.when(diff < 0.10, "Good").when(diff < 0.20, "Off").otherwise("Divergent").alias("alignment")))
