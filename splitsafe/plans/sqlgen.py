"""Small helpers for writing the DuckDB oracle SQL of the registered queries.

The oracles are independent formulations (plain GROUP BY / window SQL); these
helpers only save repeating the same CASE ladders in every query.
"""

from __future__ import annotations

from ..functions.hashing import sql_hash_int, sql_hash_uniform, sql_gaussian  # noqa: F401
from ..functions.numeric import sql_guarded_corr, sql_round6  # noqa: F401
from ..functions import tiers


def case(rules, default) -> str:
    body = " ".join(f"WHEN {cond} THEN {lit(v)}" for cond, v in rules)
    return f"(CASE {body} ELSE {lit(default)} END)"


def lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def risk_weight(risk: str) -> str:
    return "CAST(" + case([(f"{risk} = '{k}'", v) for k, v in tiers.RISK_WEIGHTS.items()], 0) + " AS INTEGER)"


def score_level(s: str) -> str:
    return case([(f"{s} = 0", "CLEAN"), (f"{s} <= 10", "LOW"), (f"{s} <= 25", "MEDIUM"),
                 (f"{s} <= 45", "HIGH")], "CRITICAL")


def level_advice(lv: str) -> str:
    return case([(f"{lv} = '{k}'", v) for k, v in tiers.LEVEL_ADVICE.items()], "")


def fmt_int(x: str) -> str:
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


def fmt_fixed(x: str, d: int) -> str:
    return f"printf('%.{d}f', round_even(({x})::DOUBLE, {d}))"


def inflation_severity(i: str) -> str:
    return case([(f"{i} > 0.15", "CRITICAL"), (f"{i} > 0.08", "HIGH"), (f"{i} > 0.03", "MODERATE")], "LOW")


def gauge_severity(i: str) -> str:
    return case([(f"{i} > 0.05", "HIGH"), (f"{i} > 0.02", "MODERATE")], "LOW")


def auc_interpretation(a: str) -> str:
    return case([(f"{a} >= {t}", label) for t, label in tiers.AUC_COARSE if t is not None],
                tiers.AUC_COARSE[-1][1])


def auc_guide(a: str) -> str:
    return case([(f"{a} >= {t}", label) for t, label in tiers.AUC_FINE if t is not None],
                tiers.AUC_FINE[-1][1])


def missing_tier(p: str) -> str:
    return case([(f"{p} > 40", "severe"), (f"{p} > 10", "moderate")], "mild")


def correlation_tier(c: str) -> str:
    return case([(f"{c} > 0.5", "suspicious"), (f"{c} > 0.3", "high")], "normal")


def scan_report_sql(view: str, columns, cats, nums, time_cols, group, id_) -> str:
    """The five checks of the detector over one view whose schema is spelled out."""
    names = tiers.CHECK_NAMES
    fixes = tiers.CHECK_FIXES
    c1 = " + ".join(f"CAST(count(DISTINCT {c}) < 100 AS BIGINT)" for c in cats) or "CAST(0 AS BIGINT)"
    corr = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, abs({sql_guarded_corr(f'CAST({c} AS DOUBLE)', 'CAST(target AS DOUBLE)')}) AS a "
        f"FROM {view}" for c in nums)
    gcol = group or id_
    allc = ", ".join(columns)
    id_part = (f"(SELECT count(*) AS id_dupes FROM (SELECT {id_} FROM {view} WHERE {id_} IS NOT NULL "
               f"GROUP BY {id_} HAVING count(*) > 1))") if id_ else "(SELECT CAST(0 AS BIGINT) AS id_dupes)"
    sql = f"""
c1 AS (SELECT {c1} AS n FROM {view}),
cr AS ({corr}),
c2 AS (SELECT count(*) FILTER (WHERE a > 0.8) AS n_critical,
              count(*) FILTER (WHERE a > 0.5 AND a <= 0.8) AS n_high,
              count(*) FILTER (WHERE a > 0.3) AS n_medium,
              count(*) FILTER (WHERE a > 0.5) AS n_over FROM cr WHERE a IS NOT NULL),
g AS (SELECT {gcol}, count(*) AS size FROM {view} WHERE {gcol} IS NOT NULL GROUP BY {gcol}),
c4 AS (SELECT count(*) AS n_groups, CAST(sum(CASE WHEN size > 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_multi,
              CAST(sum(CASE WHEN size > 1 THEN 1 ELSE 0 END) AS DOUBLE) / NULLIF(count(*), 0) AS share FROM g),
dd AS (SELECT count(*) AS c FROM {view} GROUP BY {allc}),
c5 AS (SELECT CAST(sum(c) AS BIGINT) AS n_rows, CAST(sum(c - 1) AS BIGINT) AS exact,
              (SELECT id_dupes FROM {id_part}) AS id_dupes FROM dd),
rep AS (
 SELECT 1 AS "check", {lit(names[0])} AS name,
        {case([("n = 0", "CLEAN"), ("n <= 2", "LOW"), ("n <= 5", "MEDIUM")], "HIGH")} AS risk,
        CAST(n AS VARCHAR) || ' categorical col(s) at risk of target encoding leak.' AS message,
        {lit(fixes[0])} AS fix, CAST(NULL AS BIGINT) AS exact_dupes, CAST(NULL AS BIGINT) AS id_dupes,
        CAST(NULL AS BIGINT) AS n_groups, CAST(NULL AS BIGINT) AS n_multi_groups, CAST(n AS BIGINT) AS n_flagged
 FROM c1
 UNION ALL
 SELECT 2, {lit(names[1])},
        {case([("n_critical > 0", "CRITICAL"), ("n_high > 0", "HIGH"), ("n_medium > 0", "MEDIUM")], "CLEAN")},
        CAST(n_critical AS VARCHAR) || ' critical (>0.8), ' || CAST(n_high AS VARCHAR) || ' high (>0.5) correlation features.',
        {lit(fixes[1])}, NULL, NULL, NULL, NULL, n_over FROM c2
 UNION ALL
 SELECT 3, {lit(names[2])}, {lit('MEDIUM' if time_cols else 'LOW')},
        {lit(tiers.MSG_CHECK3.format(n=len(time_cols)))}, {lit(fixes[2])}, NULL, NULL, NULL, NULL,
        {len(time_cols)}
 UNION ALL
 SELECT 4, {lit(names[3])},
        {case([("n_multi = 0", "CLEAN"), ("coalesce(share, 0) < 0.05", "LOW"), ("coalesce(share, 0) < 0.20", "MEDIUM")], "HIGH")},
        {fmt_int('n_multi')} || ' of ' || {fmt_int('n_groups')} || ' groups (' || coalesce({fmt_fixed('share * 100', 1)}, 'nan') || '%) have multiple rows.',
        {lit(fixes[3])}, NULL, NULL, n_groups, n_multi, NULL FROM c4
 UNION ALL
 SELECT 5, {lit(names[4])},
        {case([("exact = 0", "CLEAN"), ("coalesce(exact * 100.0 / NULLIF(n_rows, 0), 0) < 1", "LOW"), ("coalesce(exact * 100.0 / NULLIF(n_rows, 0), 0) < 5", "MEDIUM")], "HIGH")},
        {fmt_int('exact')} || ' exact duplicate rows (' || coalesce({fmt_fixed('exact * 100.0 / NULLIF(n_rows, 0)', 2)}, 'nan') || '%). ' || {fmt_int('id_dupes')} || ' duplicate IDs.',
        {lit(fixes[4])}, exact, id_dupes, NULL, NULL, NULL FROM c5)
"""
    return sql


def scan_report_select() -> str:
    return (f'SELECT "check", name, risk, message, fix, exact_dupes, id_dupes, n_groups, n_multi_groups, '
            f"n_flagged, {risk_weight('risk')} AS weight FROM rep")


def scan_score_select(view_label: str) -> str:
    s = "CAST(least(sum(" + risk_weight("risk") + "), 100) AS INTEGER)"
    return (f"SELECT {lit(view_label)} AS view, score, {score_level('score')} AS level, "
            f"{level_advice(score_level('score'))} AS advice FROM (SELECT {s} AS score FROM rep)")


def strat_ctes(src: str, key: str, p: str, target: str = "target", test_size: float = 0.2, seed: int = 42) -> str:
    """CTEs ``{p}_*`` ending in ``{p}_s``: ``src`` plus an exact stratified ``split`` column."""
    h = sql_hash_int(seed, key)
    return f"""
{p}_c AS (SELECT {target} AS tg, count(*) AS cnt FROM {src} WHERE {target} IS NOT NULL GROUP BY {target}),
{p}_t AS (SELECT sum(cnt) AS n, CAST(ceil({test_size!r}::DOUBLE * sum(cnt)) AS BIGINT) AS n_test FROM {p}_c),
{p}_a AS (SELECT c.tg, c.cnt, (c.cnt * (t.n - t.n_test)) / t.n::DOUBLE AS cont,
                 floor((c.cnt * (t.n - t.n_test)) / t.n::DOUBLE) AS fl, t.n - t.n_test AS n_train FROM {p}_c c, {p}_t t),
{p}_b AS (SELECT *, row_number() OVER (ORDER BY cont - fl DESC, cnt, CAST(tg AS VARCHAR)) AS rk,
                 n_train - sum(fl) OVER () AS extra FROM {p}_a),
{p}_al AS (SELECT tg, cnt - (fl + CASE WHEN rk <= extra THEN 1 ELSE 0 END) AS n_test_c FROM {p}_b),
{p}_r AS (SELECT x.*, row_number() OVER (PARTITION BY {target} ORDER BY {h}, {key}) AS __rn FROM {src} x),
{p}_s AS (SELECT r.* EXCLUDE (__rn), CASE WHEN r.{target} IS NULL THEN NULL WHEN __rn <= al.n_test_c THEN 'test'
                 ELSE 'train' END AS split FROM {p}_r r LEFT JOIN {p}_al al ON r.{target} = al.tg)"""


def auc_cte(name: str, rel: str, score: str = "score", target: str = "target") -> str:
    """CTE ``name`` with one column ``auc`` over ``rel(target, score)`` (ties count half)."""
    return f"""
{name} AS (SELECT sum(pos * (nb + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc FROM (
  SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY sc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
  FROM (SELECT CAST({score} AS DOUBLE) AS sc,
               CAST(sum(CASE WHEN {target} = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS pos,
               CAST(sum(CASE WHEN {target} = 1 THEN 0 ELSE 1 END) AS DOUBLE) AS neg
        FROM {rel} WHERE {score} IS NOT NULL AND {target} IS NOT NULL GROUP BY 1)))"""


def memorise_cte(name: str, s: str, keys, target: str = "target") -> str:
    """CTE ``name(target, score)`` over test rows of ``s``: mean train label of rows sharing ``keys``."""
    k = ", ".join(keys)
    on = " AND ".join(f"x.{c} = e.{c}" for c in keys)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    return f"""
{name}_e AS (SELECT {k}, avg(CAST({target} AS DOUBLE)) AS e FROM {s} WHERE split = 'train' AND {nn} GROUP BY {k}),
{name}_m AS (SELECT avg(CAST({target} AS DOUBLE)) AS m FROM {s} WHERE split = 'train'),
{name} AS (SELECT x.{target}, coalesce(e.e, (SELECT m FROM {name}_m)) AS score
           FROM {s} x LEFT JOIN {name}_e e ON {on} WHERE x.split = 'test')"""
