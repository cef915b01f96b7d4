"""The GLM report on one row per order.

The SQL side states the fit as Newton steps written out one after the other: each is an aggregate
of the information matrix and the score over the rows, followed by an elimination in plain columns.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators.glm import BinomialGLM
from quarry.operators.project import expand_grid
from quarry.plans.models import ORDER_FEATURES_SQL, order_features
from quarry.plans.registry import SIG6, register
from quarry.plans.sqlhelp import sql_eliminate

TERMS = ["n_lines", "avg_discount", "o_orderpriority"]
LEVELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
NAMES = ["(Intercept)", "n_lines", "avg_discount", *(f"o_orderpriority_{x}" for x in LEVELS[1:])]
P, STEPS = len(NAMES), 7


def _glm(spark, sf) -> BinomialGLM:
    return BinomialGLM(order_features(spark, sf), "label", TERMS)


def _row_sql(numeric: str, discount: str, priority: str) -> str:
    return ", ".join(["1.0 AS x0", f"CAST({numeric} AS DOUBLE) AS x1", f"{discount} AS x2",
                      *(f"CAST({priority} = '{x}' AS DOUBLE) AS x{3 + k}" for k, x in enumerate(LEVELS[1:]))])


def _eta(b: str = "b", x: str = "") -> str:
    return " + ".join(f"{b}{j} * {x}x{j}" for j in range(P))


def _irls_sql() -> str:
    """CTEs x (rows), beta (b0 ..), cov (v_i_j) and like (log likelihood)."""
    out = [ORDER_FEATURES_SQL, f"x AS MATERIALIZED (SELECT o_orderkey, label AS y, {_row_sql('n_lines', 'avg_discount', 'o_orderpriority')} FROM of)",
           f"b0 AS (SELECT {', '.join(f'0.0 AS b{j}' for j in range(P))})"]
    for s in range(STEPS + 1):
        last = s == STEPS
        sums = [f"sum(w * x{min(i, j)} * x{max(i, j)}) AS a_{i}_{j}" for i in range(P) for j in range(P)]
        sums += [f"{float(i == j)} AS a_{i}_{P + j}" for i in range(P) for j in range(P)] if last else \
            [f"sum(r * x{i}) AS a_{i}_{P}" for i in range(P)]
        out.append(f"s{s} AS MATERIALIZED (SELECT {', '.join(sums)} FROM (SELECT x.*, mu * (1 - mu) AS w, y - mu AS r FROM ("
                   f"SELECT x.*, 1 / (1 + exp(-({_eta()}))) AS mu FROM x, b{s}) x) x)")
        out.append(sql_eliminate(f"s{s}", f"e{s}_", P, P if last else 1))
        if not last:
            out.append(f"b{s + 1} AS MATERIALIZED (SELECT {', '.join(f'b{i} + a_{i}_{P} AS b{i}' for i in range(P))} FROM b{s}, e{s}_{P - 1})")
    out.append(f"beta AS (SELECT * FROM b{STEPS})")
    out.append(f"cov AS MATERIALIZED (SELECT {', '.join(f'a_{i}_{P + j} AS v_{i}_{j}' for i in range(P) for j in range(P))} FROM e{STEPS}_{P - 1})")
    out.append(f"lk AS (SELECT sum(y * eta - ln(1 + exp(eta))) AS ll, avg(y) AS m, count(*) AS n FROM (SELECT y, {_eta()} AS eta FROM x, beta))")
    return "WITH " + ",\n".join(out)


IRLS = _irls_sql()
_Z = "1.959963984540054"
_TERM_ROWS = " UNION ALL ".join(f"SELECT '{t}' AS term, b{j} AS estimate, sqrt(v_{j}_{j}) AS std_error FROM beta, cov" for j, t in enumerate(NAMES))
_VAR = " + ".join(f"{1 if i == j else 2} * v_{i}_{j} * x{i} * x{j}" for i in range(P) for j in range(i, P))
_BAND = (f"{_eta()} AS fit, sqrt({_VAR}) AS se_fit")


def _terms(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@register("glm_fit_orders", f"""{IRLS}
SELECT term, estimate, std_error, estimate / std_error AS z, estimate - {_Z} * std_error AS ci_lo, estimate + {_Z} * std_error AS ci_hi
FROM ({_TERM_ROWS})
""", {c: SIG6 for c in ("estimate", "std_error", "z", "ci_lo", "ci_hi")})
def glm_fit_orders(spark, sf):
    """Coefficients, standard errors and Wald intervals."""
    g = _glm(spark, sf)
    return _terms(spark, [(*c[:4], lo, hi) for c, (_, lo, hi) in zip(g.coefficients(), g.confint_wald())],
                  "term string, estimate double, std_error double, z double, ci_lo double, ci_hi double")


@register("glm_odds_ratios_orders", f"""{IRLS}
SELECT term, exp(estimate) AS odds_ratio, exp(estimate - {_Z} * std_error) AS lo, exp(estimate + {_Z} * std_error) AS hi
FROM ({_TERM_ROWS})
""", {c: SIG6 for c in ("odds_ratio", "lo", "hi")})
def glm_odds_ratios_orders(spark, sf):
    """Odds ratios with their bounds."""
    return _terms(spark, _glm(spark, sf).odds_ratios(), "term string, odds_ratio double, lo double, hi double")


@register("glm_deviance_orders", f"""{IRLS}
SELECT null_deviance, -2 * ll AS deviance, null_deviance + 2 * ll AS chi2, {P - 1} AS df, ll AS log_likelihood, -2 * ll + {2 * P} AS aic
FROM (SELECT *, -2 * n * (m * ln(m) + (1 - m) * ln(1 - m)) AS null_deviance FROM lk)
""", {c: SIG6 for c in ("null_deviance", "deviance", "chi2", "log_likelihood", "aic")})
def glm_deviance_orders(spark, sf):
    """The fit as a whole against the null model."""
    r = _glm(spark, sf).lr_test()
    return _terms(spark, [tuple(r[c] for c in ("null_deviance", "deviance", "chi2", "df", "log_likelihood", "aic"))],
                  "null_deviance double, deviance double, chi2 double, df int, log_likelihood double, aic double")


@register("glm_contrast_orders", f"""{IRLS}
SELECT 'medium - not specified' AS contrast, (b4 - b5) * (b4 - b5) / (v_4_4 + v_5_5 - 2 * v_4_5) AS chi2, 1 AS df FROM beta, cov
UNION ALL SELECT 'high', b3 * b3 / v_3_3, 1 FROM beta, cov
""", {"chi2": SIG6})
def glm_contrast_orders(spark, sf):
    """Two levels against each other, and one against the reference."""
    g = _glm(spark, sf)
    unit = lambda **at: [float(at.get(f"x{j}", 0)) for j in range(P)]
    rows = [(name, *g.wald_test(contrast=c)[:2]) for name, c in (("medium - not specified", unit(x4=1, x5=-1)), ("high", unit(x3=1)))]
    return _terms(spark, rows, "contrast string, chi2 double, df int")


@register("glm_predict_band_orders", f"""{IRLS}
SELECT o_orderkey, fit, se_fit, 1 / (1 + exp(-fit)) AS prob, 1 / (1 + exp(-(fit - {_Z} * se_fit))) AS prob_lo,
       1 / (1 + exp(-(fit + {_Z} * se_fit))) AS prob_hi FROM (SELECT o_orderkey, {_BAND} FROM x, beta, cov)
""", {c: SIG6 for c in ("fit", "se_fit", "prob", "prob_lo", "prob_hi")})
def glm_predict_band_orders(spark, sf):
    """M22 for every order."""
    df = order_features(spark, sf)
    return BinomialGLM(df, "label", TERMS).predict_with_se(df).select("o_orderkey", "fit", "se_fit", "prob", "prob_lo", "prob_hi")


@register("glm_grid_band_orders", f"""{IRLS},
g AS (SELECT n_lines, o_orderpriority, {_row_sql('n_lines', 'd', 'o_orderpriority')}
      FROM (SELECT CAST(unnest(range(0, 8)) AS DOUBLE) AS n_lines), (SELECT DISTINCT o_orderpriority FROM of),
           (SELECT avg(avg_discount) AS d FROM of))
SELECT n_lines, o_orderpriority, fit, se_fit, 1 / (1 + exp(-fit)) AS prob, 1 / (1 + exp(-(fit - {_Z} * se_fit))) AS prob_lo,
       1 / (1 + exp(-(fit + {_Z} * se_fit))) AS prob_hi FROM (SELECT n_lines, o_orderpriority, {_BAND} FROM g, beta, cov)
""", {c: SIG6 for c in ("fit", "se_fit", "prob", "prob_lo", "prob_hi")})
def glm_grid_band_orders(spark, sf):
    """M22 on P13's grid: every priority at 0 to 7 lines, the discount at its mean."""
    df = order_features(spark, sf)
    g = BinomialGLM(df, "label", TERMS)
    grid = expand_grid(df, "n_lines", 0, 7, 8, "o_orderpriority", ["avg_discount"])
    return g.predict_with_se(grid).select("n_lines", "o_orderpriority", "fit", "se_fit", "prob", "prob_lo", "prob_hi")


@register("glm_coefficients_orders")
def glm_coefficients_orders(spark, sf):
    """M17, M18, M21 in one table, with p values."""
    g = _glm(spark, sf)
    rows = [(*c, lo, hi, *orr[1:]) for c, (_, lo, hi), orr in zip(g.coefficients(), g.confint_wald(), g.odds_ratios())]
    return _terms(spark, rows, "term string, estimate double, std_error double, z double, p_value double, ci_lo double, ci_hi double, "
                               "odds_ratio double, odds_lo double, odds_hi double")


@register("glm_tests_orders")
def glm_tests_orders(spark, sf):
    """Wald test of all priorities, of two against each other, and the likelihood-ratio test."""
    g = _glm(spark, sf)
    lr = g.lr_test()
    rows = [("wald_priority", *g.wald_test([t for t in g.terms if t.startswith("o_orderpriority")])),
            ("wald_medium_not_specified", *g.wald_test(contrast=[0, 0, 0, 0, 1, -1, 0])),
            ("likelihood_ratio", lr["chi2"], lr["df"], lr["p_value"])]
    return _terms(spark, rows, "test string, chi2 double, df int, p_value double")


@register("glm_profile_confint_orders")
def glm_profile_confint_orders(spark, sf):
    """Profile-likelihood interval of every coefficient, with the odds ratios of the bounds."""
    rows = [(t, float(lo), float(hi), ok) for t, lo, hi, ok in _glm(spark, sf).profile_confint()]
    return _terms(spark, rows, "term string, lo double, hi double, converged boolean").select(
        "*", F.exp("lo").alias("odds_lo"), F.exp("hi").alias("odds_hi"))
