"""Honest training pipeline (J7-J13): impute → scale → logistic regression → exact AUC.

The fit table (medians, means, population stds) is computed on the training
rows only and applied as literals; spark.ml's ``LogisticRegression`` then runs
with ``regParam = 1 / (C · n_train)``, no elastic net and no internal
standardisation, which is the same objective as an L2 model with inverse
regularisation strength ``C`` on pre-scaled inputs.  The scaled training
frame is persisted for the optimiser's passes and released afterwards.

Every fit can be checked: :func:`certificate` gives the gradient and the Hessian of that
objective at any weights as sums of one aggregate.  For up to ``POLISH_FEATURES`` features
the fit ends with Newton steps from the optimiser's weights until the gradient vanishes, so
the weights are the objective's only minimum and don't depend on the optimiser's tolerance.
"""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .concurrent import run_concurrently
from .complement import fold_fit_stats
from .fit import apply_fit, fit_stats
from .metrics import roc_auc

# ---------------------------------------------------------------------------
# FIXED VALUES — model settings of the audited experiments.
# ---------------------------------------------------------------------------
C = 0.1
MAX_ITER = 1000
# ---------------------------------------------------------------------------
POLISH_FEATURES = 24        # the Hessian is one sum a pair of features
POLISH_STEPS = 20
NEAR = 1e-6                 # largest gradient entry a row from which one more step is enough
FLAT = 1e-10                # largest gradient entry a row at which a fit counts as settled


def probability(features, weights) -> F.Column:
    """P(class 1) of scaled ``features`` under ``weights`` (intercept first)."""
    z = reduce(add, [F.col(f) * F.lit(float(w)) for f, w in zip(features, weights[1:])], F.lit(float(weights[0])))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def certificate(train: DataFrame, features, target: str, weights, c: float = C,
                hessian: bool = True) -> tuple[int, np.ndarray, np.ndarray | None]:
    """``(n, gradient, Hessian)`` of ``sum(log loss) + |w|^2 / (2 c)`` at ``weights`` (intercept first, not
    regularised) over scaled ``train`` rows: one aggregate of sums, a row to the driver."""
    features = list(features)
    d = len(features) + 1
    x = [F.lit(1.0), *[F.col(f) for f in features]]
    # the weights enter as one array, not as constants in generated code, which each step would compile anew
    dot = F.aggregate(F.zip_with(F.array(*x), F.lit([float(w) for w in weights]), lambda a, b: a * b), F.lit(0.0), add)
    scored = train.select(target, *features, (F.lit(1.0) / (F.lit(1.0) + F.exp(-dot))).alias("__p"))
    rows = scored.select(*features, (F.col("__p") - F.col(target).cast("double")).alias("__e"),
                         (F.col("__p") * (1 - F.col("__p"))).alias("__q"))
    sums = [F.sum(F.col("__e") * x[i]) for i in range(d)]
    pairs = [(i, j) for i in range(d) for j in range(i, d)] if hessian else []
    sums += [F.sum(F.col("__q") * x[i] * x[j]) for i, j in pairs]
    got = rows.agg(F.count(F.lit(1)), *[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
    n, values = got[0], np.array([v or 0.0 for v in got[1:]])
    ridge = np.r_[0.0, np.full(d - 1, 1.0 / c)]
    g = values[:d] + ridge * np.asarray(weights, float)
    if not hessian:
        return n, g, None
    h = np.zeros((d, d))
    for (i, j), v in zip(pairs, values[d:]):
        h[i, j] = h[j, i] = v
    return n, g, h + np.diag(ridge)


def polish(train: DataFrame, features, target: str, weights, c: float = C) -> np.ndarray:
    """Newton steps from ``weights`` until the gradient vanishes; a step that doesn't lessen it is halved."""
    w = np.asarray(weights, float)
    n, g, h = certificate(train, features, target, w, c)
    for _ in range(POLISH_STEPS):
        if np.abs(g).max() <= FLAT * max(n, 1):
            break
        step = np.linalg.lstsq(h, g, rcond=None)[0]
        if np.abs(g).max() <= NEAR * max(n, 1):
            return w - step                         # Newton squares so small a gradient: below FLAT without a look
        for _ in range(30):
            n, g2, h2 = certificate(train, features, target, w - step, c)
            if np.abs(g2).max() < np.abs(g).max():
                w, g, h = w - step, g2, h2
                break
            step = step / 2
        else:
            break                                   # as small as the sums' rounding lets it be
    return w


def fit_logistic(train: DataFrame, features, target: str, n_train: int | None = None, c: float = C,
                 max_iter: int = MAX_ITER) -> np.ndarray:
    """Weights (intercept first) of the L2 logistic regression on scaled, persisted ``train`` rows."""
    features = list(features)
    if not features:
        return np.zeros(1)
    if n_train is None:
        n_train = train.count()
    lr = LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter,
                            regParam=1.0 / (c * max(n_train, 1)), elasticNetParam=0.0,
                            standardization=False, fitIntercept=True, tol=1e-6)
    model = lr.fit(VectorAssembler(inputCols=features, outputCol="features").transform(train).select(
        F.col(target).cast("double").alias("label"), "features"))
    w = np.r_[model.intercept, model.coefficients.toArray()]
    if len(features) <= POLISH_FEATURES and np.isfinite(w).all():
        w = polish(train, features, target, w, c)
    return w


def fit_predict(train: DataFrame, test: DataFrame, features, target: str, fit_on: DataFrame | None = None,
                keep=(), c: float = C, max_iter: int = MAX_ITER, fit: list | None = None, held: bool = False) -> DataFrame:
    """Fit impute+scale on ``fit_on`` (default: ``train``; ``fit``: rows of that fit, if known), train LR on ``train`` and
    return ``test`` rows as ``keep..., target, score`` (probability of class 1). ``held``: the rows are of a persisted
    frame, of which no further copy is made (scaled again in each pass, next to the optimiser's own blocks)."""
    features = list(features)
    known = fit is not None
    if not known:
        fit = fit_stats(fit_on if fit_on is not None else train, features, persist=not held).collect()
    used = [r["feature"] for r in fit if r["median"] is not None]
    tr = apply_fit(train, fit, used, keep=[target])
    if not held:
        tr.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # the fit table counted the training rows already unless it was fitted elsewhere
        w = fit_logistic(tr, used, target, fit[0]["n"] if (fit_on is None and fit) else None, c, max_iter)
    finally:
        if not held:
            tr.unpersist()
    te = apply_fit(test, fit, used, keep=list(dict.fromkeys([*keep, target])))
    return te.select(*keep, target, probability(used, w).alias("score"))


def fit_report(train: DataFrame, features, target: str, c: float = C) -> DataFrame:
    """The fitted model and its certificate: ``parameter, weight, gradient`` (of the objective, a training row),
    for the scaled features; a gradient of 0 everywhere marks the convex objective's minimum."""
    fit = fit_stats(train, features).collect()
    used = [r["feature"] for r in fit if r["median"] is not None]
    tr = apply_fit(train, fit, used, keep=[target]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        w = fit_logistic(tr, used, target, c=c)
        n, g, _ = certificate(tr, used, target, w, c, hessian=False)
    finally:
        tr.unpersist()
    rows = [(p, float(x), float(y) / max(n, 1)) for p, x, y in zip(["intercept", *used], w, g)]
    return train.sparkSession.createDataFrame(rows, "parameter string, weight double, gradient double")


def train_and_evaluate(df: DataFrame, features, target: str, split_col: str = "split",
                       label: str = "HONEST BASELINE", fit_on_all: bool = False, held: bool = False) -> DataFrame:
    """One-row result ``label, auc, n_train, n_test, default_rate`` (test rate).

    ``fit_on_all=True`` fits the imputer/scaler on every row (the leak of
    experiment 3); the model itself always trains on the train rows only. ``held``: ``df`` is persisted.
    """
    train = df.where(F.col(split_col) == "train")
    test = df.where(F.col(split_col) == "test")
    pred = fit_predict(train, test, features, target, fit_on=df if fit_on_all else None, held=held)
    auc = roc_auc(pred, "score", target)
    sizes = df.groupBy().agg(F.count(F.when(F.col(split_col) == "train", 1)).alias("n_train"),
                             F.count(F.when(F.col(split_col) == "test", 1)).alias("n_test"),
                             F.avg(F.when(F.col(split_col) == "test", F.col(target).cast("double")))
                             .alias("default_rate"))
    sz = sizes.select(F.struct("n_train", "n_test", "default_rate")).scalar()   # one subquery
    return auc.select(F.lit(label).alias("label"), "auc",
                      *[sz[c].alias(c) for c in ("n_train", "n_test", "default_rate")])


def kfold_evaluate(df: DataFrame, features, target: str, group: str, fold_col: str = "fold",
                   k: int = 5, held: bool = False) -> DataFrame:
    """Per-fold AUC with the fold as test and the rest as train, plus per-fold
    group overlap (0 by construction); the caller averages (E14). The fit tables of all folds come
    from one pass, and two folds are trained at a time, so that two training copies are held at most (``held``: ``df``
    is persisted, and they are the optimiser's blocks)."""
    spark, features = df.sparkSession, list(features)
    fits = {}
    for r in fold_fit_stats(df.where(F.col(fold_col).isNotNull()), features, fold_col).collect():
        fits.setdefault(r["fold"], []).append(r)

    def one(f):
        tr = df.where(F.col(fold_col) != f)
        te = df.where(F.col(fold_col) == f)
        pred = fit_predict(tr, te, features, target, fit=fits.get(f), held=held)      # a fold without rows has no fit here
        auc = roc_auc(pred, "score", target).collect()[0]["auc"]
        return f, auc

    # per-fold overlap for every fold in one aggregate: a group overlaps fold f when it has
    # rows in f and outside f, i.e. when it spans more than one fold
    spans = (df.where(F.col(group).isNotNull()).groupBy(group)
             .agg(F.min(fold_col).alias("lo"), F.max(fold_col).alias("hi")))
    shared = (df.join(spans.where(F.col("lo") != F.col("hi")).select(group), group, "left_semi")
              .groupBy(fold_col).agg(F.countDistinct(group).alias("ov")))
    results = run_concurrently(*[(lambda f=f: one(f)) for f in range(k)], max_workers=2)
    ov = {r[fold_col]: r["ov"] for r in shared.collect()}
    rows = [(f, auc, int(ov.get(f, 0))) for f, auc in results]
    return spark.createDataFrame(rows, "fold int, auc double, overlap bigint")
