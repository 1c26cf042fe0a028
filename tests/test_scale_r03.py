"""Work per row of the steps that large tables are slow in, and their results."""

from pyspark.sql import functions as F

from splitsafe.roles import Roles
from splitsafe.operators import complement, encode, experiments, metrics, profile


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_stack_names_no_column_per_value(spark):
    df = spark.createDataFrame([(1, 1.0, None, 3.0), (2, None, 5.0, 6.0)], "k int, a double, `b c` double, d double")
    long = profile.stack_columns(df, {c: F.col(f"`{c}`") for c in ("a", "b c", "d")}, keep=["k"], chunk=2)
    assert long.dtypes == [("k", "int"), ("__slot", "int"), ("x", "double")]
    assert sorted(long.collect(), key=lambda r: r[:2]) == [(1, 0, 1.0), (1, 1, None), (1, 2, 3.0), (2, 0, None), (2, 1, 5.0), (2, 2, 6.0)]
    assert "Expand" not in plan(long) and "substring" not in plan(long)


def test_first_histogram_of_complements_is_arithmetic(spark, monkeypatch):
    """Over the whole table no sketch of quantiles is made and no list of cuts searched; the later passes are small."""
    df = spark.range(40_000).select((F.col("id") % 5).cast("int").alias("fold"), F.pmod(F.hash("id"), F.lit(1_000_003)).cast("double").alias("a"))
    seen = []
    narrow, sketch = complement._narrow, complement._cut_points
    monkeypatch.setattr(complement, "_narrow", lambda v, r, t: seen.append(("rows", v.count(), {x[2] is None for x in r.values()})) or narrow(v, r, t))
    monkeypatch.setattr(complement, "_cut_points", lambda *a: seen.append(("sketch",)) or sketch(*a))
    got = {r["fold"]: r["median"] for r in complement.fold_fit_stats(df, ["a"], "fold").collect()}
    assert seen[0] == ("rows", 40_000, {True})
    assert all(s[1] < 2_000 for s in seen[1:] if s[0] == "rows") and len(seen) > 2
    pd = df.toPandas()
    assert got == {f: pd.a[pd.fold != f].median() for f in range(5)}


def held(df):
    return "InMemoryRelation" in df._jdf.queryExecution().withCachedData().toString()


def test_leaks_split_the_table_once(spark, monkeypatch):
    """What the encodings and the AUCs read several times is held, narrow, and released."""
    df = spark.range(600).select(F.col("id").alias("k"), (F.col("id") % 50).alias("g"), (F.hash("id") % 2 == 0).cast("int").alias("y"),
                                 (F.col("id") % 7).cast("double").alias("a"), F.lit("wide").alias("other"))
    seen = []
    lookup, auc = encode.lookup, metrics.roc_auc
    monkeypatch.setattr(encode, "lookup", lambda d, *a, **k: seen.append((held(d), "other" in d.columns)) or lookup(d, *a, **k))
    monkeypatch.setattr(experiments, "roc_auc", lambda d, *a, **k: seen.append((held(d), "other" in d.columns)) or auc(d, *a, **k))
    before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    roles = Roles(target="y", id="k", group="g", row_key="k")
    for leak in (lambda: experiments.leak1_target_encoding(df, roles, "g"), lambda: experiments.leak2_injected_feature(df, roles, "a"),
                 lambda: experiments.leak4_group_overlap(df, roles), lambda: experiments.leak5_duplicates(df, roles, ["a", "g"])):
        assert leak().count() == 1
    assert len(seen) == 14 and set(seen) == {(True, False)}
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == before


def test_baseline_reads_its_tables_once(spark, monkeypatch):
    from splitsafe.operators import model
    from splitsafe.plans import queries_model
    seen = []
    evaluate, report = model.train_and_evaluate, model.fit_report
    monkeypatch.setattr(model, "train_and_evaluate", lambda d, *a, **k: seen.append(held(d)) or evaluate(d, *a, **k))
    monkeypatch.setattr(model, "fit_report", lambda d, *a, **k: seen.append(held(d)) or report(d, *a, **k))
    queries_model.model_baseline(spark, "/root/testdata/sf0.001").collect()
    queries_model.logreg_gradient(spark, "/root/testdata/sf0.001").collect()
    assert seen == [True, True]


def test_experiments_hold_no_more_than_they_fit_on(spark, monkeypatch):
    """While models are fitted, only the two split tables are held: no inputs of theirs, no second copies."""
    from splitsafe.operators import model
    cache = spark._jsparkSession.sharedState().cacheManager()
    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 50).alias("g"), (F.hash("id") % 2 == 0).cast("int").alias("y"),
                                 (F.hash("id", "id") % 97).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"))
    before, seen, fit = cache.numCachedEntries(), [], model.fit_logistic
    monkeypatch.setattr(model, "fit_logistic", lambda t, *a, **k: seen.append((cache.numCachedEntries() - before, t.storageLevel.useMemory)) or fit(t, *a, **k))
    roles = Roles(target="y", id="k", group="g", row_key="k")
    experiments.experiment_5(df, roles, ["a", "b"]).collect()
    assert len(seen) == 2 and all(n <= 2 and not copy for n, copy in seen)
    seen.clear()
    experiments.experiment_4(df, roles, ["a", "b"]).collect()
    assert len(seen) == 6 and not any(copy for _, copy in seen) and min(n for n, _ in seen) == 2
    assert cache.numCachedEntries() == before
