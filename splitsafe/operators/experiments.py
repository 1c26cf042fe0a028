"""The five leakage experiments: a leaky arm and an honest arm → inflation.

Model experiments (J14-J18) train the honest pipeline of :mod:`.model` in both
arms.  Model-free variants (J20) score test rows with the leaked quantity
itself — the encoded category, the injected feature, the group's or the
identical row's training label — so the inflation is checkable in SQL.

Each function returns one row: ``sin, name, honest_auc, leaky_auc, inflation``.
Both arms use the same md5 split of the same row key, so the only difference
between them is the leak.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.tiers import EXPERIMENT_NAMES
from ..roles import Roles
from . import clean, encode, inject, model, split
from .concurrent import run_concurrently
from .duplicates import drop_duplicates
from .fit import fit_stats
from .metrics import roc_auc


def copy_key(df: DataFrame, key: str, copy_col: str = "copy_no", of: DataFrame | None = None) -> F.Column:
    """Unique key of an original or appended row of ``df``: ``2 * key + copy_no`` for whole numbers (as a decimal where
    64 bits don't hold it), else the key as text with the copy number behind it. ``of``: the rows that ``df`` holds with
    some copies; they have the same keys and need no sampling."""
    dt = df.schema[key].dataType
    if isinstance(dt, T.LongType):
        most = (df if of is None else of).agg(F.max(F.col(key)), F.min(F.col(key))).first()
        small = all(m is None or -(1 << 62) < m < (1 << 62) for m in most)
        return F.col(key).cast("bigint" if small else "decimal(20,0)") * F.lit(2) + F.col(copy_col)
    if isinstance(dt, T.IntegralType):
        return F.col(key).cast("bigint") * 2 + F.col(copy_col)
    return F.concat(F.col(key).cast("string"), F.lit("#"), F.col(copy_col).cast("string"))


@contextmanager
def working_set(*frames):
    """Persist frames that several passes read (fits, splits, AUCs) and release them after."""
    held = [f.persist(StorageLevel.MEMORY_AND_DISK) for f in frames]
    try:
        yield held if len(held) > 1 else held[0]
    finally:
        for f in held:
            f.unpersist()


def _settle(frames, *sources):
    """Compute the held ``frames`` now and release the ``sources`` they were made of before their block ends."""
    for f in frames:
        f.count()
    for f in sources:
        f.unpersist()


def materialize(res: DataFrame) -> DataFrame:
    """One-row result computed now, so that it survives the release of its inputs."""
    return res.sparkSession.createDataFrame(res.collect(), res.schema)


def _arms(honest, leaky):
    """Run the honest and the leaky arm as concurrent Spark jobs; both come back materialised."""
    return run_concurrently(lambda: materialize(honest()), lambda: materialize(leaky()))


def _result(sin: int, honest: DataFrame, leaky: DataFrame) -> DataFrame:
    h = honest.select(F.col("auc").alias("honest_auc"))
    r = h.select(F.lit(sin).alias("sin"), F.lit(EXPERIMENT_NAMES[sin]).alias("name"), "honest_auc",
                 leaky.select("auc").scalar().alias("leaky_auc"))
    return r.withColumn("inflation", F.col("leaky_auc") - F.col("honest_auc"))


@contextmanager
def split_rows(df: DataFrame, roles: Roles, features, seed: int = 42):
    """The features and target of ``df`` with an exact stratified ``split``, held for the passes of fits and AUCs: joins
    behind ``df`` run once."""
    cols = list(dict.fromkeys([roles.row_key, roles.target, *features]))
    with working_set(df.select(*cols)) as base:
        with working_set(split.stratified_split(base, roles.target, roles.row_key, 0.2, seed)) as s:
            yield s


# ----------------------------------------------------------------- model-free

def _row_split(df: DataFrame, roles: Roles, seed: int, mode: str) -> DataFrame:
    if mode == "hash":
        return split.hash_split(df, roles.row_key, 0.2, seed)
    return split.stratified_split(df, roles.target, roles.row_key, 0.2, seed)


def leak1_target_encoding(df: DataFrame, roles: Roles, cat: str, seed: int = 42,
                          mode: str = "stratified") -> DataFrame:
    """Score = mean target of the row's category; leaky fit on all rows, honest on train.

    ``mode='hash'`` uses the one-pass ``h mod 10 < 2`` split instead of the exact
    stratified one."""
    with working_set(_row_split(df, roles, seed, mode).select(*dict.fromkeys([cat, roles.target, "split"]))) as s:
        return _result(1, *_arms(lambda: _memorised_auc(s, cat, roles.target),
                                 lambda: _memorised_auc(s, cat, roles.target, train_only=False)))


def leak2_injected_feature(df: DataFrame, roles: Roles, honest_feature: str, seed: int = 42) -> DataFrame:
    """Leaky score = a post-outcome feature; honest score = a legitimate feature."""
    s = split.stratified_split(df, roles.target, roles.row_key, 0.2, seed)
    s = inject.inject_target_feature(s, roles.target, roles.row_key, "SYNTHETIC_RISK_SCORE", seed)
    test = s.where("split = 'test'").select(honest_feature, "SYNTHETIC_RISK_SCORE", F.col(roles.target).alias("__y"))
    with working_set(test) as test:
        return _result(2, *_arms(lambda: roc_auc(test, honest_feature, "__y"),
                                 lambda: roc_auc(test, "SYNTHETIC_RISK_SCORE", "__y")))


def _memorised_auc(s: DataFrame, keys, target: str, null_safe: bool = False, train_only: bool = True) -> DataFrame:
    """AUC on the test rows of a score that is the mean training label of the rows sharing ``keys`` (unseen → training
    mean); without ``train_only`` the mean label of all of them, test rows included. ``s`` is read several times."""
    test = s.where("split = 'test'")
    if train_only:
        mean = s.where("split = 'train'").agg(F.avg(F.col(target).cast("double"))).first()[0]
        table = encode.encoding_table(s, keys, target, F.col("split") == "train", "score")
        scored = encode.lookup(test, table, keys, null_safe).withColumn("score", F.coalesce("score", F.lit(mean).cast("double")))
    else:
        scored = encode.lookup(test, encode.encoding_table(s, keys, target, None, "score"), keys, null_safe)
    with working_set(scored.select("score", F.col(target).alias("__y"))) as scored:
        return materialize(roc_auc(scored, "score", "__y"))


def leak4_group_overlap(df: DataFrame, roles: Roles, seed: int = 42, k: int = 5) -> DataFrame:
    """Memorise the group's label: row split (groups shared) vs group split (fold 0 held out)."""
    cols = list(dict.fromkeys([roles.group, roles.target, "split"]))
    rows = split.stratified_split(df, roles.target, roles.row_key, 0.2, seed).select(*cols)
    grp = split.group_kfold(df, roles.group, k, seed).withColumn(
        "split", F.when(F.col("fold") == 0, "test").otherwise("train")).select(*cols)
    with working_set(grp, rows) as (grp, rows):
        return _result(4, *_arms(lambda: _memorised_auc(grp, roles.group, roles.target),
                                 lambda: _memorised_auc(rows, roles.group, roles.target)))


def leak5_duplicates(df: DataFrame, roles: Roles, features, frac: float = 0.08, seed: int = 42) -> DataFrame:
    """Memorise identical rows: 8 % injected copies split apart vs de-duplicated first."""
    features = list(features)
    narrow = df.select(*dict.fromkeys([roles.row_key, roles.target, *features]))
    inj = inject.inject_duplicates(narrow, roles.row_key, frac, seed)
    inj = inj.select(*dict.fromkeys([*features, roles.target]), copy_key(inj, roles.row_key, of=narrow).alias("__rk"))
    with working_set(inj) as inj:
        leaky = split.stratified_split(inj, roles.target, "__rk", 0.2, seed).drop("__rk")
        with working_set(drop_duplicates(inj, features + [roles.target], row_key="__rk")) as dedup:
            honest = split.stratified_split(dedup, roles.target, "__rk", 0.2, seed).drop("__rk")
            with working_set(honest, leaky) as (honest, leaky):
                return _result(5, *_arms(lambda: _memorised_auc(honest, features, roles.target, null_safe=True),
                                         lambda: _memorised_auc(leaky, features, roles.target, null_safe=True)))


# ----------------------------------------------------------------- model experiments

def _impute_global(df: DataFrame, features) -> DataFrame:
    """The audited arms 2-5 fill NULLs with medians of *all* rows before splitting (Q2)."""
    fit = fit_stats(df, features).collect()
    med = {r["feature"]: r["median"] for r in fit}
    return df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(med[c])).alias(c) if c in features
                       else F.col(c) for c in df.columns])


def _cleaned(df: DataFrame, features, keep) -> tuple[DataFrame, list[str]]:
    """The cleaning that the audited experiments 2-5 begin with: mostly missing columns, duplicate rows, quirks.
    ``keep`` columns (keys, target, order) stay; features that cleaning drops are left out."""
    out, _ = clean.clean(df.select(*dict.fromkeys([*keep, *features])), keep=tuple(keep))
    return out, [f for f in features if f in out.columns]


def experiment_1(df: DataFrame, roles: Roles, cat: str, features, seed: int = 42,
                 clean_first: bool = False, oof_folds: int | None = None) -> DataFrame:
    """Target encoding fitted on all rows (leaky) vs on train rows (honest).

    The audited experiment runs on uncleaned data (Q6); ``clean_first=True`` applies
    the sentinel/abs quirk fixes first (the category column is kept).  In the
    audited honest arm each training row's encoding still contains its own label
    (Q16); ``oof_folds=k`` encodes training rows out-of-fold instead."""
    features = list(features)
    if clean_first:
        df = clean.fix_quirks(df)[0]
    cols = list(dict.fromkeys([roles.row_key, roles.target, cat] + features))
    with working_set(df.where(F.col(cat).isNotNull()).select(*cols)) as data:
        with working_set(split.stratified_split(data, roles.target, roles.row_key, 0.2, seed)) as s:
            leaky = encode.target_encode(s, cat, roles.target, None, fallback=None, name="CAT_ENCODED")
            if oof_folds:
                honest = encode.target_encode_oof(s, cat, roles.target, roles.row_key, k=oof_folds, seed=seed,
                                                  name="CAT_ENCODED")
            else:
                honest = encode.target_encode(s, cat, roles.target, F.col("split") == "train", fallback="mean",
                                              name="CAT_ENCODED")
            feats = features + ["CAT_ENCODED"]
            h, lk = _arms(lambda: model.train_and_evaluate(honest, feats, roles.target, label="SIN 1 HONEST"),
                          lambda: model.train_and_evaluate(leaky, feats, roles.target, label="SIN 1 LEAKY"))
            return materialize(_result(1, h, lk))


def experiment_2(df: DataFrame, roles: Roles, features, seed: int = 42, compat: bool = False,
                 clean_first: bool = False) -> DataFrame:
    """A post-outcome feature added (leaky) vs not (honest).  ``clean_first``: see :func:`_cleaned`."""
    features = list(features)
    if clean_first:
        df, features = _cleaned(df, features, [roles.row_key, roles.target])
    cols = list(dict.fromkeys([roles.row_key, roles.target] + features))
    with working_set(df.select(*cols)) as base:
        data = _impute_global(base, features) if compat else base
        s = split.stratified_split(data, roles.target, roles.row_key, 0.2, seed)
        s = inject.inject_target_feature(s, roles.target, roles.row_key, "SYNTHETIC_RISK_SCORE", seed)
        with working_set(s) as s:
            h, lk = _arms(lambda: model.train_and_evaluate(s, features, roles.target, label="SIN 2 HONEST", held=True),
                          lambda: model.train_and_evaluate(s, features + ["SYNTHETIC_RISK_SCORE"], roles.target,
                                                           label="SIN 2 LEAKY", held=True))
            return materialize(_result(2, h, lk))


def experiment_3(df: DataFrame, roles: Roles, features, order_by, frac: float = 0.8,
                 compat: bool = False, clean_first: bool = False) -> DataFrame:
    """past/future split; imputer+scaler fitted on all rows (leaky) vs past only (honest).
    ``clean_first``: see :func:`_cleaned`."""
    features = list(features)
    if clean_first:
        df, features = _cleaned(df, features, [*order_by, roles.target])
    cols = list(dict.fromkeys(list(order_by) + [roles.target] + features))
    with working_set(df.select(*cols)) as base:
        data = _impute_global(base, features) if compat else base
        with working_set(split.temporal_split(data, order_by, frac)) as s:
            h, lk = _arms(lambda: model.train_and_evaluate(s, features, roles.target, label="SIN 3 HONEST", held=True),
                          lambda: model.train_and_evaluate(s, features, roles.target, label="SIN 3 LEAKY",
                                                           fit_on_all=True, held=True))
            return materialize(_result(3, h, lk))


def experiment_4(df: DataFrame, roles: Roles, features, frac: float = 0.30, seed: int = 42, k: int = 5,
                 compat: bool = False, with_folds: bool = False, clean_first: bool = False):
    """30 % of groups duplicated with noise; row split (leaky) vs group k-fold mean (honest).

    The audited comparison sets one 20 % split against a 5-fold mean (Q5);
    ``with_folds=True`` also returns the per-fold table (AUC and overlap of each
    held-out fold) as ``(result, folds)``.  ``clean_first``: see :func:`_cleaned`."""
    features = list(features)
    if clean_first:
        df, features = _cleaned(df, features, [roles.row_key, roles.group, roles.target])
    cols = list(dict.fromkeys([roles.row_key, roles.group, roles.target] + features))
    with working_set(df.select(*cols)) as base:
        data = _impute_global(base, features) if compat else base
        sim = inject.inject_group_overlap(data, roles.group, roles.row_key, features, frac, 0.05, seed)
        sim = sim.withColumn("__rk", copy_key(sim, roles.row_key, of=base))
        with working_set(split.group_kfold(sim, roles.group, k, seed)) as sim:           # read by 1 + k fits
            _settle([sim], base)
            rows = split.stratified_split(sim, roles.target, "__rk", 0.2, seed)
            with working_set(rows.select(*dict.fromkeys([*features, roles.target, "split"]))) as rows:
                per_fold, leaky = _arms(
                    lambda: model.kfold_evaluate(sim, features, roles.target, roles.group, k=k, held=True),
                    lambda: model.train_and_evaluate(rows, features, roles.target, label="SIN 4 LEAKY", held=True))
                res = materialize(_result(4, per_fold.agg(F.avg("auc").alias("auc")), leaky))
                return (res, per_fold) if with_folds else res


def experiment_5(df: DataFrame, roles: Roles, features, frac: float = 0.08, seed: int = 42,
                 compat: bool = False, clean_first: bool = False) -> DataFrame:
    """8 % exact duplicates injected; split as is (leaky) vs de-duplicate first (honest).
    ``clean_first``: see :func:`_cleaned`."""
    features = list(features)
    if clean_first:
        df, features = _cleaned(df, features, [roles.row_key, roles.target])
    cols = list(dict.fromkeys([roles.row_key, roles.target] + features))
    with working_set(df.select(*cols)) as base:
        data = _impute_global(base, features) if compat else base
        inj = inject.inject_duplicates(data, roles.row_key, frac, seed)
        inj = inj.select(*dict.fromkeys([*features, roles.target]), copy_key(inj, roles.row_key, of=base).alias("__rk"))
        with working_set(inj) as inj:
            _settle([inj], base)
            lk = split.stratified_split(inj, roles.target, "__rk", 0.2, seed).drop("__rk")
            dedup = drop_duplicates(inj, features + [roles.target], row_key="__rk")
            with working_set(lk, dedup) as (lk, dedup):
                _settle([lk, dedup], inj)
                with working_set(split.stratified_split(dedup, roles.target, "__rk", 0.2, seed).drop("__rk")) as hn:
                    _settle([hn], dedup)
                    h, l5 = _arms(
                        lambda: model.train_and_evaluate(hn, features, roles.target, label="SIN 5 HONEST", held=True),
                        lambda: model.train_and_evaluate(lk, features, roles.target, label="SIN 5 LEAKY", held=True))
                    return materialize(_result(5, h, l5))


def scaling_fit_drift(df: DataFrame, features, order_by, frac: float = 0.8) -> DataFrame:
    """J6 on a temporal split: how far all-row statistics drift from past-only ones."""
    from .fit import fit_drift
    s = split.temporal_split(df, order_by, frac)
    return fit_drift(s, features, F.col("split") == "train")

