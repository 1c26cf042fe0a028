"""Exact order statistics without an un-partitioned window (K1).

Every place the audited workflow relies on in-memory row order — the first 80 %
of rows, the exact per-class test counts of a stratified split, the n smallest
hashes of a sample, medians — is a *selection* problem: find the value of rank
``k`` (per group).  A global ``row_number()`` would move every row into one task.

``select_kth`` narrows instead: a histogram pass over ``[lo, hi]`` with
``n_buckets`` equal-width buckets counts rows per bucket (map-side partial
aggregation; output is ``groups x buckets`` rows), a small window over that
histogram finds the bucket holding rank ``k``, and the next pass looks only at
that bucket's value range.  Values that are all equal end the search at once
(hot keys cost nothing).  Where equal widths cut little (values over many decades,
an infinite end), the next pass cuts that range at approximate quantiles, with a bucket
of its own for each cut value, so every range shrinks to a small share per pass and the
search always ends.  When the remaining candidate range holds at most
``max_exact`` rows per (group, rank), a window *partitioned by group and rank* over just
those rows finishes exactly.

The state is one row per group and rank: its range, and the ranks below it.  For up to
``DRIVER_STATE`` groups (classes, features) a pass collects these rows, never data rows.
Beyond that the state is a table: each pass joins it with the histogram and writes it to
the checkpoint folder, groups of at most ``max_exact`` rows go straight to the last window,
and only two counts reach the driver, however many groups there are.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

N_BUCKETS = 4096
MAX_EXACT = 20_000
N_CUTS = 64                 # quantiles of a range that equal widths don't narrow
DRIVER_STATE = 1_000        # groups whose selection state fits the driver easily; a table beyond
BROADCAST_STATE = 200_000   # state rows that are broadcast, after a count; joined beyond
MIDDLE = "array_distinct(array((cnt - 1) div 2, cnt div 2))"   # ranks of the one or two middle values of cnt


def orderable(df: DataFrame, c: str) -> F.Column:
    """A numeric column with the same order as ``c`` (timestamps as epoch microseconds,
    computed without going through the session time zone)."""
    dt = df.schema[c].dataType
    if isinstance(dt, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{c}`)")
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(F.col(c))
    if isinstance(dt, T.DateType):
        return F.unix_date(F.col(c))
    if isinstance(dt, T.BooleanType):
        return F.col(c).cast("int")
    return F.col(c)


def order_parts(df: DataFrame, c: str) -> list[F.Column]:
    """Columns whose lexicographic order is exactly that of ``c``: DOUBLE, or STRING where no double serves.
    64-bit integers and timestamps become their upper and lower 32 bits, since a double holds 53 bits only;
    a decimal of more than 15 digits becomes its sign and all its digits as text."""
    dt = df.schema[c].dataType
    if isinstance(dt, T.StringType):
        return [F.col(c)]
    if isinstance(dt, T.BinaryType):
        return [F.hex(c)]
    if isinstance(dt, T.DecimalType) and dt.precision > 15:
        whole = dt.precision - dt.scale
        digits = "0" * max(whole, 1) + ("." + "0" * dt.scale if dt.scale else "")
        text = f"to_char(`{c}`, 'S{digits}')"          # its sign, then every digit (abs() would round)
        # the smaller a negative number, the greater its digits
        return [F.expr(f"if(`{c}` < 0, '0' || translate(substring({text}, 2), '0123456789', '9876543210'), "
                       f"'1' || substring({text}, 2))")]
    x = orderable(df, c)
    if isinstance(dt, (T.LongType, T.TimestampType, T.TimestampNTZType)):
        return [F.shiftright(x, 32).cast("double"), x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("double")]
    return [x.cast("double")]


PIECE_BYTES = 6             # with their number, 51 bits of a double


def _piece(x: F.Column, skip: F.Column) -> F.Column:
    """The next bytes of a text behind the first ``skip``, as a number of the same order."""
    own = F.substring(x.cast("binary"), skip + 1, F.lit(PIECE_BYTES))
    return F.conv(F.rpad(F.hex(own), 2 * PIECE_BYTES, "0"), 16, 10).cast("double") * 8 + F.octet_length(own)


def _select_text(data: DataFrame, value: str, targets, gcols, **kw) -> list[dict]:
    """:func:`select_kth` for text in byte order, one rank a group: piece by piece until one value is left.

    The texts still in question lie between ``lo`` and ``hi``, so they share the bytes that these two share; the
    next piece begins behind them, which tells at least ``lo`` from ``hi``. State: a row a group, on the driver.
    """
    spark = data.sparkSession
    x = data.where(F.col(value).isNotNull())

    def ends(rows):
        return rows.groupBy(*gcols).agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(F.lit(1)).alias("cnt"))

    init = {tuple(r[g] for g in gcols): r.asDict() for r in ends(x).collect()}
    if callable(targets):
        targets = targets({k: r["cnt"] for k, r in init.items()})
    state, out = {}, []
    for t in targets:
        key = tuple(t[g] for g in gcols)
        if key in init and 0 <= t["k"] < init[key]["cnt"]:
            state[key] = {**init[key], "k0": int(t["k"]), "k": int(t["k"])}
        else:
            out.append({**dict(zip(gcols, key)), "k": int(t["k"]), "value": None, "n_less": None, "n_eq": None})
    schema = T.StructType([x.schema[g] for g in gcols] + [
        T.StructField("__lo", T.StringType()), T.StructField("__hi", T.StringType()),
        T.StructField("__skip", T.IntegerType()), T.StructField("__v", T.DoubleType())])
    while live := {key: r for key, r in state.items() if r["lo"] != r["hi"]}:
        def rows(v=None):
            st = spark.createDataFrame([key + (r["lo"], r["hi"], _shared(r["lo"], r["hi"]), v[key] if v else None)
                                        for key, r in live.items()], schema)
            j = _null_safe_join(x, F.broadcast(st), gcols)
            return (j.where((F.col(value) >= F.col("__lo")) & (F.col(value) <= F.col("__hi")))
                    .withColumn("__piece", _piece(F.col(value), F.col("__skip"))))

        ks = [{**dict(zip(gcols, key)), "k": r["k"]} for key, r in live.items()]
        picked = {}
        for r in select_kth(rows().select(*gcols, "__piece"), "__piece", ks, gcols, **kw).collect():
            key = tuple(r[g] for g in gcols)
            picked[key] = r["value"]
            live[key]["k"] -= r["n_less"]
        for r in ends(rows(picked).where("__piece = __v")).collect():
            live[tuple(r[g] for g in gcols)].update(lo=r["lo"], hi=r["hi"], cnt=r["cnt"])
    out += [{**dict(zip(gcols, key)), "k": r["k0"], "value": r["lo"], "n_less": r["k0"] - r["k"], "n_eq": r["cnt"]}
            for key, r in state.items()]
    return out


def _shared(a: str, b: str) -> int:
    """Bytes that two texts have in common at their beginning."""
    x, y = a.encode(), b.encode()
    return next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


def _gkey(group_cols):
    return list(group_cols) if group_cols else ["__g"]


def select_kth(data: DataFrame, value: str, targets, group_cols=(),
               n_buckets: int = N_BUCKETS, max_exact: int = MAX_EXACT,
               persist: bool = True) -> DataFrame:
    """Value of 0-based rank ``k`` in ascending order of ``value`` (NULLs ignored).

    ``targets`` (a DataFrame, a list of row dicts, or a function from the
    per-group counts ``{group key tuple: n}`` to such a list) has
    ``group_cols + ['k']``; several ``k`` per group are allowed.  As a SQL expression of an array of
    ranks over ``cnt`` (a group's number of values, see ``MIDDLE``) it serves any number of groups;
    the other forms name their groups on the driver.  Returns an already materialised
    DataFrame ``group_cols + ['k', 'value', 'n_less', 'n_eq']`` where ``n_less`` counts the
    values strictly below the selected one and ``n_eq`` those equal to it; ``value`` is NULL when the
    group has fewer than ``k + 1`` values.  The narrow ``(group, value)`` projection is
    persisted for the passes and released before returning.
    """
    out = _select(data, value, targets, group_cols, n_buckets, max_exact, persist)
    if not isinstance(out, DataFrame):
        out = data.sparkSession.createDataFrame(*out)
    return out if group_cols else out.drop("__g")


def _select(data: DataFrame, value: str, targets, group_cols=(), n_buckets: int = N_BUCKETS,
            max_exact: int = MAX_EXACT, persist: bool = True):
    """:func:`select_kth`: a DataFrame, or for few groups the rows and their schema."""
    spark = data.sparkSession
    gcols = _gkey(group_cols)
    x = data.select(*[F.col(g) for g in group_cols], F.col(value).cast("double").alias("__x"))
    if not group_cols:
        x = x.withColumn("__g", F.lit(1))
    x = x.where(F.col("__x").isNotNull() & ~F.isnan("__x"))
    gschema = [x.schema[g] for g in gcols]
    out_schema = T.StructType(gschema + [T.StructField("k", T.LongType()), T.StructField("value", T.DoubleType()),
                                         T.StructField("n_less", T.LongType()), T.StructField("n_eq", T.LongType())])

    def gk(r):
        return tuple(r[g] for g in gcols)

    if persist:
        x = x.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes = x.groupBy(*gcols).agg(F.min("__x").alias("lo"), F.max("__x").alias("hi"), F.count(F.lit(1)).alias("cnt"))
        ranks = F.expr(targets) if isinstance(targets, str) else F.lit(None)
        init_rows = sizes.withColumn("ks", ranks).limit(DRIVER_STATE + 1).collect()
        if len(init_rows) > DRIVER_STATE:
            if not isinstance(targets, str):
                sizes = cut_lineage(sizes)
                if callable(targets):       # one rank a class: the caller holds its classes on the driver anyway
                    targets = targets({gk(r)[:len(group_cols)]: r["cnt"] for r in sizes.toLocalIterator()})
                if isinstance(targets, list):
                    targets = spark.createDataFrame([tuple(t[g] for g in gcols) + (int(t["k"]),) for t in targets],
                                                    T.StructType(gschema + [T.StructField("k", T.LongType())]))
            return _select_in_tables(x, sizes, targets, gcols, n_buckets, max_exact, out_schema)
        init = {gk(r): r for r in init_rows}
        if isinstance(targets, str):
            trows = [{**{g: r[g] for g in gcols}, "k": k} for r in init_rows for k in r["ks"]]
        elif callable(targets):
            trows = targets({(k if group_cols else ()): v["cnt"] for k, v in init.items()})
        elif isinstance(targets, list):
            trows = targets
        else:
            trows = [r.asDict() for r in targets.collect()]
        if not group_cols and not isinstance(targets, str):
            trows = [dict(r, __g=1) for r in trows]
        state = []
        for t in trows:
            g = init.get(gk(t))
            if g is not None and 0 <= t["k"] < g["cnt"]:
                state.append({**{c: t[c] for c in gcols}, "k": int(t["k"]), "lo": g["lo"], "hi": g["hi"],
                              "cnt": g["cnt"], "below": 0, "cuts": None})
        st_schema = T.StructType(gschema + [T.StructField("k", T.LongType()), T.StructField("lo", T.DoubleType()),
                                            T.StructField("hi", T.DoubleType()), T.StructField("cnt", T.LongType()),
                                            T.StructField("below", T.LongType()),
                                            T.StructField("cuts", T.ArrayType(T.DoubleType()))])
        fields = [f.name for f in st_schema.fields]

        def as_df(rows):
            return spark.createDataFrame([tuple(r[f] for f in fields) for r in rows], st_schema)

        def open_(r):
            return r["lo"] != r["hi"] and r["cnt"] > max_exact

        def inside(rows):
            """The values in the ranges of ``rows``, once per (group, rank)."""
            st = as_df(rows).withColumnsRenamed({g: f"__s{i}" for i, g in enumerate(gcols)})
            same = [F.col(g).eqNullSafe(F.col(f"__s{i}")) for i, g in enumerate(gcols)]
            return x.join(F.broadcast(st), same, "inner").where(
                (F.col("__x") >= F.col("lo")) & (F.col("__x") <= F.col("hi")))

        slow = set()                             # (group, rank) that the last pass narrowed too little
        while active := [r for r in state if open_(r)]:
            uneven = [r for r in active if gk(r) + (r["k"],) in slow or not math.isfinite(r["hi"] - r["lo"])]
            if uneven:
                steps = F.array(*[F.lit(i / N_CUTS) for i in range(N_CUTS + 1)])
                found = {gk(r) + (r["k"],): sorted(set(r["cuts"])) for r in inside(uneven).groupBy(*gcols, "k").agg(
                    F.percentile_approx("__x", steps, 10_000).alias("cuts")).collect()}
                for r in uneven:
                    r["cuts"] = found[gk(r) + (r["k"],)]
            j = inside(active)
            width = F.least(F.floor((F.col("__x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * n_buckets),
                            F.lit(n_buckets - 1))
            # an even bucket between two cuts, an odd one for values equal to a cut
            cut = F.expr("2 * size(filter(cuts, c -> c < __x)) + if(array_contains(cuts, __x), 1, 0)")
            b = F.when(F.col("cuts").isNull(), width).otherwise(cut.cast("long"))
            hist = j.groupBy(*gcols, "k", "below", b.alias("b")).agg(
                F.count(F.lit(1)).alias("c"), F.min("__x").alias("blo"), F.max("__x").alias("bhi"))
            # the histogram has at most n_buckets rows per (group, k): a bounded window
            w = Window.partitionBy(*gcols, "k").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
            hist = hist.withColumn("before", F.coalesce(F.sum("c").over(w), F.lit(0)))
            pick = hist.where((F.col("below") + F.col("before") <= F.col("k"))
                              & (F.col("k") < F.col("below") + F.col("before") + F.col("c")))
            upd = {gk(r) + (r["k"],): {**{c: r[c] for c in gcols}, "k": r["k"], "lo": r["blo"], "hi": r["bhi"],
                                       "cnt": r["c"], "below": r["below"] + r["before"], "cuts": None}
                   for r in pick.collect()}
            slow = {gk(r) + (r["k"],) for r in active if 4 * upd[gk(r) + (r["k"],)]["cnt"] > r["cnt"]}
            state = [upd.get(gk(r) + (r["k"],), r) if open_(r) else r for r in state]

        result = [gk(r) + (r["k"], float(r["lo"]), r["below"], r["cnt"]) for r in state if r["lo"] == r["hi"]]
        todo = [r for r in state if r["lo"] != r["hi"]]
        if todo:
            j = inside(todo)
            w = Window.partitionBy(*gcols, "k").orderBy("__x")     # at most max_exact rows per group and rank
            ties = Window.partitionBy(*gcols, "k", "__x")
            ranked = j.select(*gcols, "k", "__x",
                              (F.col("below") + F.row_number().over(w) - 1).alias("at"),
                              (F.col("below") + F.rank().over(w) - 1).alias("n_less"),
                              F.count(F.lit(1)).over(ties).alias("n_eq"))
            hit = ranked.where("at = k")
            result += [gk(r) + (r["k"], r["__x"], r["n_less"], r["n_eq"]) for r in hit.collect()]
    finally:
        if persist:
            x.unpersist()
    found = {row[:len(gcols) + 1]: row for row in result}
    rows = [found.get(gk(t) + (int(t["k"]),), gk(t) + (int(t["k"]), None, None, None)) for t in trows]
    return rows, out_schema


def _select_in_tables(x: DataFrame, sizes: DataFrame, targets, gcols, n_buckets: int, max_exact: int,
                      out_schema: T.StructType) -> DataFrame:
    """The search of :func:`select_kth` with its state (a row per group and rank) as a table."""
    if isinstance(targets, str):
        start = sizes.withColumn("k", F.explode(F.expr(targets)))
        asked = None
    else:
        asked = targets.select(*gcols, F.col("k").cast("long").alias("k"))
        start = _null_safe_join(sizes, asked, gcols)
    start = start.where((F.col("k") >= 0) & (F.col("k") < F.col("cnt")))
    state = cut_lineage(start.select(*gcols, "k", "lo", "hi", "cnt", F.lit(0).cast("long").alias("below"),
                                     F.col("cnt").alias("n"), F.lit(False).alias("slow")))
    open_ = (F.col("lo") != F.col("hi")) & (F.col("cnt") > max_exact)
    # widths that overflow, or a range that the last pass hardly narrowed, are cut at quantiles
    uneven = F.col("slow") | (F.abs(F.col("hi") - F.col("lo")) == float("inf"))

    def inside(st, n):
        j = _null_safe_join(x, F.broadcast(st) if n <= BROADCAST_STATE else st, gcols)
        return j.where((F.col("__x") >= F.col("lo")) & (F.col("__x") <= F.col("hi")))

    while True:
        n_open, n_uneven = state.where(open_).agg(F.count(F.lit(1)), F.count(F.when(uneven, 1))).first()
        if not n_open:
            break
        act = state.where(open_).withColumn("cuts", F.lit(None).cast("array<double>"))
        if n_uneven:
            steps = F.array(*[F.lit(i / N_CUTS) for i in range(N_CUTS + 1)])
            found = inside(state.where(open_ & uneven), n_uneven).groupBy(*gcols, "k").agg(
                F.array_sort(F.array_distinct(F.percentile_approx("__x", steps, 10_000))).alias("__cuts"))
            act = (_null_safe_join(act, found, gcols + ["k"], "left")
                   .withColumn("cuts", F.col("__cuts")).drop("__cuts"))
        width = F.least(F.floor((F.col("__x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * n_buckets),
                        F.lit(n_buckets - 1))
        cut = F.expr("2 * size(filter(cuts, c -> c < __x)) + if(array_contains(cuts, __x), 1, 0)")
        b = F.when(F.col("cuts").isNull(), width).otherwise(cut.cast("long"))
        hist = inside(act, n_open).groupBy(*gcols, "k", "below", "n", F.col("cnt").alias("was"), b.alias("b")).agg(
            F.count(F.lit(1)).alias("cnt"), F.min("__x").alias("lo"), F.max("__x").alias("hi"))
        w = Window.partitionBy(*gcols, "k").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
        hist = hist.withColumn("at", F.col("below") + F.coalesce(F.sum("cnt").over(w), F.lit(0)))
        pick = hist.where((F.col("at") <= F.col("k")) & (F.col("k") < F.col("at") + F.col("cnt")))
        state = cut_lineage(state.where(~open_).unionByName(pick.select(
            *gcols, "k", "lo", "hi", "cnt", F.col("at").alias("below"), "n", (4 * F.col("cnt") > F.col("was")).alias("slow"))))

    keys = gcols + ["k"]
    found = state.where("lo = hi").select(*keys, F.col("lo").alias("value"), F.col("below").alias("n_less"),
                                          F.col("cnt").alias("n_eq"))
    w, ties = Window.partitionBy(*keys).orderBy("__x"), Window.partitionBy(*keys, "__x")

    def ranked(j):                      # at most max_exact rows per group and rank
        return j.select(*keys, F.col("__x").alias("value"), (F.col("below") + F.row_number().over(w) - 1).alias("at"),
                        (F.col("below") + F.rank().over(w) - 1).alias("n_less"),
                        F.count(F.lit(1)).over(ties).alias("n_eq")).where("at = k").select(*keys, "value", "n_less", "n_eq")

    # rows of groups that were narrowed are picked out by their ranges; the other groups are small as they are
    large = state.where((F.col("n") > max_exact) & (F.col("lo") != F.col("hi")))
    hot = state.where(F.col("n") > max_exact).select(*gcols).distinct()
    n_large, n_hot = large.count(), hot.count()
    if n_large:
        found = found.unionByName(ranked(inside(large, n_large)))
    small = x
    if n_hot:
        small = _null_safe_join(x, F.broadcast(hot) if n_hot <= BROADCAST_STATE else hot, gcols, "left_anti")
    rest = state.where((F.col("n") <= max_exact) & (F.col("lo") != F.col("hi")))
    found = found.unionByName(ranked(_null_safe_join(small, rest, gcols)))
    if asked is not None:               # ranks beyond a group's values: NULL
        found = _null_safe_join(asked, found, keys, "left")
    return cut_lineage(found.select(*[f.name for f in out_schema.fields]))


def _null_safe_join(left: DataFrame, right: DataFrame, cols, how: str = "inner") -> DataFrame:
    """Join on ``cols`` with NULL equal to NULL; the columns of ``left`` stand for both."""
    r = right.withColumnsRenamed({c: f"__r{i}" for i, c in enumerate(cols)})
    same = [F.col(c).eqNullSafe(F.col(f"__r{i}")) for i, c in enumerate(cols)]
    return left.join(r, same, how).drop(*[f"__r{i}" for i in range(len(cols))])


def medians(data: DataFrame, value_cols, group_cols=(), **kw) -> DataFrame:
    """Exact median per (group, column), pandas midpoint for even counts, NULLs skipped.

    The columns are unpivoted into ``(column, x)`` so that all medians share the
    same selection passes.  Returns an already materialised DataFrame
    ``group_cols + ['column', 'median']``, for any number of groups.
    """
    from .profile import stack_columns
    value_cols = list(value_cols)
    long = stack_columns(data, {c: F.col(c).cast("double") for c in value_cols}, keep=list(group_cols),
                         value="__v")
    long = long.where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    g = list(group_cols) + ["__slot"]
    found = _select(long, "__v", MIDDLE, g, **kw)
    if not isinstance(found, DataFrame):
        middle = {}
        for r in found[0]:
            middle.setdefault(r[:len(g)], []).append(r[len(g) + 1])
        rows = [key[:-1] + (value_cols[key[-1]], sum(v) / len(v)) for key, v in middle.items()]
        return data.sparkSession.createDataFrame(rows, T.StructType(
            [long.schema[c] for c in group_cols] + [T.StructField("column", T.StringType()), T.StructField("median", T.DoubleType())]))
    names = F.array(*[F.lit(c) for c in value_cols])
    return (found.groupBy(*g).agg(F.avg("value").alias("median"))
            .select(*group_cols, F.element_at(names, F.col("__slot") + 1).alias("column"), "median"))


def composite_threshold(data: DataFrame, order_cols, targets, group_cols=(), **kw) -> DataFrame:
    """Exact k-th tuple in lexicographic order of ``order_cols``, one ``k`` per group.

    Selects on the first column, then among the rows tied on it selects on the
    next, and so on.  Returns a small materialised DataFrame
    ``group_cols + ['k', 't0', 't1', ...]`` (ordered forms, see :func:`order_parts`; a 64-bit
    integer or timestamp takes two of them, text is text):
    a row is at or before the threshold iff its tuple is lexicographically
    ``<=`` it.  The narrow projection of group and order columns is persisted
    once for all passes.
    """
    spark = data.sparkSession
    gcols = list(group_cols) or ["__g"]
    base = data if group_cols else data.withColumn("__g", F.lit(1))
    parts = [p for c in order_cols for p in order_parts(data, c)]
    cur = base.select(*gcols, *[p.alias(f"__o{i}") for i, p in enumerate(parts)])
    cur = cur.persist(StorageLevel.MEMORY_AND_DISK)
    gschema = [cur.schema[g] for g in gcols]
    n = len(parts)
    texts = [isinstance(cur.schema[f"__o{i}"].dataType, T.StringType) for i in range(n)]
    kinds = [T.StringType() if t else T.DoubleType() for t in texts]
    extra = {} if group_cols else {"__g": 1}
    if callable(targets):
        def first(counts):
            return [{**t, **extra} for t in targets({k[:len(group_cols)]: v for k, v in counts.items()})]
    else:
        trows = targets if isinstance(targets, list) else [r.asDict() for r in targets.collect()]
        first = [{**{c: t[c] for c in list(group_cols) + ["k"]}, **extra} for t in trows]
    thr = {}          # group key -> {"k0", "k" (rank left among ties), "t" (thresholds), "state"}
    try:
        sub = cur
        for i in range(n):
            live = first if i == 0 else [{**dict(zip(gcols, key)), "k": v["k"]}
                                         for key, v in thr.items() if v["state"] == "open"]
            if not live:
                break
            if texts[i]:
                found = _select_text(sub, f"__o{i}", live, gcols, **kw)
            else:
                found = select_kth(sub, f"__o{i}", live, gcols, persist=(i > 0), **kw).collect()
            for r in found:
                key = tuple(r[g] for g in gcols)
                v = thr.setdefault(key, {"k0": int(r["k"]), "k": int(r["k"]), "t": [], "state": "open"})
                if r["value"] is None:
                    v["state"] = "empty"                 # fewer than k + 1 rows: no threshold
                else:
                    v["t"].append(r["value"])
                    v["k"] -= r["n_less"]
                    if r["n_eq"] == 1:
                        v["state"] = "unique"            # a unique value decides the order alone
            if i + 1 < n:
                # keep only rows tied with the selected prefix (one threshold row per group)
                pref = [key + tuple(v["t"]) for key, v in thr.items() if v["state"] == "open"]
                if not pref:
                    break
                ks = spark.createDataFrame(pref, T.StructType(gschema + [
                    T.StructField(f"__t{j}", kinds[j]) for j in range(i + 1)]))
                sub = cur.join(F.broadcast(ks), gcols, "inner")
                for j in range(i + 1):
                    sub = sub.where(F.col(f"__o{j}") == F.col(f"__t{j}"))
                sub = sub.drop(*[f"__t{j}" for j in range(i + 1)])
    finally:
        cur.unpersist()
    rows = []
    for key, v in thr.items():
        # behind a unique value nothing is compared: an end that every row reaches (None for text)
        pad = [None if t else float("inf") for t in texts]
        t = [None] * n if v["state"] == "empty" else v["t"] + pad[len(v["t"]):]
        rows.append(key + (v["k0"],) + tuple(t))
    out = spark.createDataFrame(rows, T.StructType(gschema + [T.StructField("k", T.LongType())] + [
        T.StructField(f"t{i}", kinds[i]) for i in range(n)]))
    return out if group_cols else out.drop("__g")


def at_or_before(data: DataFrame, order_cols, thr_prefix: str = "t", values: dict | None = None) -> F.Column:
    """Lexicographic ``(order_cols) <= (t0, t1, ...)``; thresholds are columns of a joined
    threshold row, or literal ``values``."""
    o = [p for c in order_cols for p in order_parts(data, c)]
    t = [values[f"{thr_prefix}{i}"] if values else F.col(f"{thr_prefix}{i}") for i in range(len(o))]
    # a text threshold that isn't there, behind a unique value, is reached by all
    expr = F.coalesce(o[-1] <= t[-1], F.lit(True)) if len(o) > 1 else o[-1] <= t[-1]
    for i in range(len(o) - 2, -1, -1):
        later = (o[i] < t[i]) | ((o[i] == t[i]) & expr)
        expr = later if i == 0 else F.coalesce(later, F.lit(True))
    return expr
