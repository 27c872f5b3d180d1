"""Split, fit, score, metrics and model comparison."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.operators.gram import Gram, gram
from shelfspark.operators.ranks import cumulative_counts
from shelfspark.operators.stats import TestResult, wilcoxon_signed
from shelfspark.session import materialize


# ---- split -------------------------------------------------------------------

def split_hash(key_cols: Sequence[str], seed: int) -> Column:
    """md5 of the key text and the seed: stable under any partitioning, and repeatable in SQL."""
    parts = [F.col(c).cast("string") for c in key_cols] + [F.lit(str(seed))]
    return F.md5(F.concat_ws("|", *parts))


def split_threshold(train_frac: float) -> str:
    return format(int(round(train_frac * 16 ** 8)), "08x")


def train_val_split_tag(df: DataFrame, key_cols: Sequence[str], seed: int = 28, train_frac: float = 0.7,
                        out: str = "split") -> DataFrame:
    """Tag rows 'train' or 'val': first 8 hex digits of the hash below the fraction threshold.
    Use integer or text keys (their text form is the same in every engine)."""
    h = F.substring(split_hash(key_cols, seed), 1, 8)
    return df.withColumn(out, F.when(h < F.lit(split_threshold(train_frac)), F.lit("train")).otherwise(F.lit("val")))


def train_val_split(df: DataFrame, key_cols: Sequence[str], seed: int = 28, train_frac: float = 0.7,
                    exact_size: bool = False) -> tuple[DataFrame, DataFrame]:
    """70/30 split by default. ``exact_size`` orders rows by the hash and cuts at
    round(frac * n) through the bucketed prefix sums (rows with equal keys stay together);
    the cut is one boundary hash, so each row is tagged by a comparison."""
    if not exact_size:
        tagged = train_val_split_tag(df, key_cols, seed, train_frac, "__split")
        return (tagged.filter(F.col("__split") == "train").drop("__split"),
                tagged.filter(F.col("__split") == "val").drop("__split"))
    hnum = F.conv(F.substring(split_hash(key_cols, seed), 1, 15), 16, 10).cast("long")
    keyed = df.withColumn("__h", hnum)
    counts = keyed.groupBy("__h").agg(F.count(F.lit(1)).alias("n"))
    cum = cumulative_counts(counts, "__h", ["n"])
    n_total = keyed.count()
    cutoff = int(math.floor(train_frac * n_total + 0.5))  # half-up, the same in every engine
    # cum_n grows with the hash, so the train rows are those up to one boundary hash:
    # a scalar, not a join of every row back to the per-hash table.
    boundary = cum.filter(F.col("cum_n") <= F.lit(cutoff)).agg(F.max("__h")).scalar()
    is_train = F.coalesce(F.col("__h") <= boundary, F.lit(False))
    return (keyed.filter(is_train).drop("__h"), keyed.filter(~is_train).drop("__h"))


# ---- linear model ------------------------------------------------------------

@dataclass
class LinearModel:
    features: list[str]
    coefficients: list[float]
    intercept: float
    label: str = "label"

    def predict_expr(self) -> Column:
        """Sum of products of columns: stays in whole-stage codegen, no vector assembly."""
        expr = F.lit(float(self.intercept))
        for f, w in zip(self.features, self.coefficients):
            expr = expr + F.col(f).cast("double") * F.lit(float(w))
        return expr

    def coefficients_frame(self, spark) -> DataFrame:
        rows = [(f, float(w)) for f, w in zip(self.features, self.coefficients)]
        rows.append(("intercept", float(self.intercept)))
        return spark.createDataFrame(rows, "feature string, weight double")

    def to_json(self) -> str:
        return json.dumps({"features": self.features, "coefficients": self.coefficients,
                           "intercept": self.intercept, "label": self.label})

    @staticmethod
    def from_json(text: str) -> "LinearModel":
        d = json.loads(text)
        return LinearModel(d["features"], d["coefficients"], d["intercept"], d.get("label", "label"))


def fit_linear(df: DataFrame, features: Sequence[str], label: str, reg_param: float = 0.0) -> LinearModel:
    """Ordinary least squares with intercept, from the centred cross-product sums (``gram``).

    The driver solves the k x k system by least squares, which gives the minimum-norm solution when columns
    are exactly collinear (dummies that sum to one); predictions and the
    identified coefficients do not depend on that choice. Rows with a null
    feature or label are left out. ``reg_param`` adds ``reg_param * n`` to the
    diagonal (ridge on the mean squared error, intercept not penalized).
    """
    return fit_from_gram(gram(df, [*dict.fromkeys([*features, label])]), features, label, reg_param)


def fit_from_gram(g: Gram, features: Sequence[str], label: str, reg_param: float = 0.0) -> LinearModel:
    """The linear model of some columns of a Gram matrix: several models of one table need one pass over it.

    The rows are those without a null in any of the matrix's columns.
    """
    import numpy as np

    if g.n == 0:
        raise ValueError("no rows with a label and all features to fit on")
    feats = list(features)
    at = [g.columns.index(f) for f in feats]
    y = g.columns.index(label)
    sxx, sxy, mx = g.sums[np.ix_(at, at)], g.sums[at, y], g.means[at]
    if reg_param:
        sxx = sxx + reg_param * g.n * np.eye(len(feats))
    # Solve on the correlation scale, so the cut-off for "exactly collinear" is relative
    # to each column's own spread (columns with no spread keep scale 1).
    d = np.sqrt(np.diag(sxx))
    d[d == 0] = 1.0
    beta = np.linalg.lstsq(sxx / np.outer(d, d), sxy / d, rcond=1e-10)[0] / d
    intercept = float(g.means[y] - mx @ beta)
    return LinearModel(feats, [float(b) for b in beta], intercept, label)


def fit_simple_linear(df: DataFrame, x: str, y: str) -> DataFrame:
    """One feature: slope and intercept as one aggregate (``regr_slope`` / ``regr_intercept``)."""
    return df.agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"), F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
                  F.regr_count(F.col(y), F.col(x)).alias("n"))


def simple_model(df: DataFrame, x: str, y: str) -> LinearModel:
    """The one-feature model; a constant feature has slope 0 and the label's mean as intercept. No complete row is an error."""
    r = df.agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"), F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
               F.regr_avgy(F.col(y), F.col(x)).alias("mean")).first()
    if r["mean"] is None:
        raise ValueError("no rows with a label and the feature to fit on")
    if r["slope"] is None:
        return LinearModel([x], [0.0], float(r["mean"]), y)
    return LinearModel([x], [float(r["slope"])], float(r["intercept"]), y)


def score_batch(df: DataFrame, model: LinearModel, out: str = "prediction") -> DataFrame:
    return df.withColumn(out, model.predict_expr())


def regression_metrics(df: DataFrame, label: str, prediction: str | Column, by: Sequence[str] = ()) -> DataFrame:
    """n, MSE, RMSE and R2 in one aggregate, per group of ``by`` (R2 from the stable ``var_pop``; null for a constant label)."""
    pred = F.col(prediction) if isinstance(prediction, str) else prediction
    err = F.col(label) - pred
    agg = df.filter(F.col(label).isNotNull() & pred.isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(err * err).alias("mse"), F.var_pop(F.col(label)).alias("__var")
    )
    return agg.select(*by, "n", "mse", F.sqrt("mse").alias("rmse"), (1 - F.try_divide(F.col("mse"), F.col("__var"))).alias("r2"))


@dataclass
class Comparison:
    r2_new: float
    r2_old: float | None
    wilcoxon: TestResult | None
    accept: bool


def compare_models(df: DataFrame, label: str, pred_new: str | Column, pred_old: str | Column | None = None,
                   alpha: float = 0.05, method: str = "normal") -> Comparison:
    """Accept the new model if its R2 is higher and the paired signed-rank test on the
    errors has p < alpha (``method`` of ``wilcoxon_signed``: "exact" for few pairs). The first model (no old
    predictions) passes.

    Both R2 come from one aggregate; the three needed columns are kept while the
    two passes (metrics, signed ranks) read them, then released.
    """
    new = F.col(pred_new) if isinstance(pred_new, str) else pred_new
    if pred_old is None:
        return Comparison(regression_metrics(df, label, new).first()["r2"], None, None, True)
    old = F.col(pred_old) if isinstance(pred_old, str) else pred_old
    scored = materialize(df.select(F.col(label).alias("y"), new.alias("p_new"), old.alias("p_old"))
                         .filter("y IS NOT NULL AND p_new IS NOT NULL AND p_old IS NOT NULL"), "persist")
    try:
        m = scored.agg(
            F.avg(F.pow(F.col("y") - F.col("p_new"), 2)).alias("mse_new"),
            F.avg(F.pow(F.col("y") - F.col("p_old"), 2)).alias("mse_old"),
            F.var_pop("y").alias("var"),
        ).first()
        r2_new = None if not m["var"] else 1 - m["mse_new"] / m["var"]
        r2_old = None if not m["var"] else 1 - m["mse_old"] / m["var"]
        w = wilcoxon_signed(scored, F.col("p_new") - F.col("y"), F.col("p_old") - F.col("y"), method)
    finally:
        scored.unpersist()
    accept = (r2_new is not None and r2_old is not None and r2_new > r2_old
              and w.p_value is not None and w.p_value < alpha)
    return Comparison(r2_new, r2_old, w, bool(accept))
