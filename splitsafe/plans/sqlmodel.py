"""Oracle SQL of the model experiments: impute, scale and an L2 logistic regression solved by Newton steps.

Nothing here comes from the operators: medians, means and deviations are DuckDB aggregates, and the fit is a
recursive CTE. Each round sums gradient and Hessian over the train rows and solves the linear system by Gaussian
elimination, one column a nested SELECT.
"""

from __future__ import annotations

from .sqlgen import auc_cte

INVERSE_REG = 0.1      # of the audited models
ROUNDS = 14


def _eliminate(d: int, inner: str) -> str:
    """SELECTs around ``inner`` (it, w0.., g0.., h0_0..) that end in the solution s0.. of h s = g."""
    keep = ["it", *[f"w{i}" for i in range(d)]]
    sql = inner
    for k in range(d):          # rows below k lose column k
        cols = []
        for i in range(d):
            if i <= k:
                cols += [f"g{i}", *[f"h{i}_{j}" for j in range(i, d)]]
            else:
                f = f"h{k}_{i} / h{k}_{k}"
                cols += [f"g{i} - {f} * g{k} AS g{i}", *[f"h{i}_{j} - {f} * h{k}_{j} AS h{i}_{j}" for j in range(i, d)]]
        sql = f"SELECT {', '.join(keep + cols)} FROM ({sql})"
    for k in reversed(range(d)):
        done = [f"s{i}" for i in range(k + 1, d)]
        rest = "".join(f" - h{k}_{i} * s{i}" for i in range(k + 1, d))
        own = [c for i in range(k) for c in (f"g{i}", *[f"h{i}_{j}" for j in range(i, d)])]
        sql = f"SELECT {', '.join(keep + own + done)}, (g{k}{rest}) / h{k}_{k} AS s{k} FROM ({sql})"
    return sql


def logit_ctes(p: str, src: str, feats, fit_where: str = "split = 'train'", train_where: str = "split = 'train'",
               test_where: str = "split = 'test'", target: str = "target") -> str:
    """CTEs ending in ``{p}_w`` (weights w0.. of the last round) and ``{p}(target, score)`` over the test rows."""
    d = len(feats) + 1
    med = ", ".join(f"median(CAST({c} AS DOUBLE)) AS m{i}" for i, c in enumerate(feats, 1))
    mom = ", ".join(f"avg(coalesce(CAST({c} AS DOUBLE), m{i})) AS a{i}, stddev_pop(coalesce(CAST({c} AS DOUBLE), m{i})) AS d{i}"
                    for i, c in enumerate(feats, 1))
    meds = ", ".join(f"m{i}" for i in range(1, d))
    scaled = ", ".join(f"(coalesce(CAST({c} AS DOUBLE), m{i}) - a{i}) / CASE WHEN d{i} > 0 THEN d{i} ELSE 1 END AS x{i}"
                       for i, c in enumerate(feats, 1))
    z = " + ".join(["w0", *[f"w{i} * x{i}" for i in range(1, d)]])
    ws = [f"w{i}" for i in range(d)]
    x = ["1.0", *[f"x{i}" for i in range(1, d)]]
    ridge = 1.0 / INVERSE_REG
    g = [f"sum(e * {x[i]})" + (f" + {ridge!r} * any_value(w{i})" if i else "") + f" AS g{i}" for i in range(d)]
    h = [f"sum(q * {x[i]} * {x[j]})" + (f" + {ridge!r}" if i and i == j else "") + f" AS h{i}_{j}"
         for i in range(d) for j in range(i, d)]
    sums = (f"SELECT it, {', '.join(f'any_value({w}) AS {w}' for w in ws)}, {', '.join(g + h)} FROM "
            f"(SELECT *, p - y AS e, p * (1 - p) AS q FROM (SELECT s.*, x.*, 1.0 / (1.0 + exp(-({z}))) AS p "
            f"FROM {p}_n s, {p}_x x WHERE x.is_train AND s.it < {ROUNDS})) GROUP BY it")
    return f"""
{p}_m AS (SELECT {med} FROM {src} WHERE {fit_where}),
{p}_f AS (SELECT {meds}, {mom} FROM {src}, {p}_m WHERE {fit_where} GROUP BY ALL),
{p}_x AS MATERIALIZED (SELECT CAST({target} AS DOUBLE) AS y, coalesce({train_where}, FALSE) AS is_train, coalesce({test_where}, FALSE) AS is_test,
       {scaled} FROM {src}, {p}_f),
{p}_n AS (SELECT 0 AS it, {', '.join(f'CAST(0 AS DOUBLE) AS {w}' for w in ws)}
  UNION ALL SELECT it + 1, {', '.join(f'w{i} - s{i}' for i in range(d))} FROM ({_eliminate(d, sums)})),
{p}_w AS (SELECT * FROM {p}_n WHERE it = {ROUNDS}),
{p} AS (SELECT x.y AS target, 1.0 / (1.0 + exp(-({z}))) AS score FROM {p}_x x, {p}_w WHERE x.is_test)"""


def logit_auc(p: str, src: str, feats, **kw) -> str:
    """:func:`logit_ctes` and ``{p}_auc(auc)``."""
    return logit_ctes(p, src, feats, **kw) + "," + auc_cte(f"{p}_auc", p)
