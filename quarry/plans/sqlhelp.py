"""Small builders for the DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Sequence


def union_all(parts: Sequence[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def sql_hash_bits(seed: int, keys: Sequence[str]) -> str:
    """DuckDB twin of :func:`quarry.functions.numeric.hash_bits`."""
    inner = ", '|', ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"CAST(('0x' || substr(md5(concat('{seed}|', {inner})), 1, 8)) AS BIGINT)"


def sql_hash_unit(seed: int, keys: Sequence[str]) -> str:
    return f"({sql_hash_bits(seed, keys)} / 4294967296.0)"


def sql_eliminate(source: str, name: str, p: int, right: int = 1, keep: tuple = ()) -> str:
    """CTEs ``name``0 .. that reduce the p x p columns a_i_j (with ``right`` more on the right) to the unit matrix."""
    parts, prev = [], source
    for k in range(p):
        cols = [f"a_{i}_{j} - a_{i}_{k} / a_{k}_{k} * a_{k}_{j} AS a_{i}_{j}" if i != k else f"a_{k}_{j} / a_{k}_{k} AS a_{k}_{j}"
                for i in range(p) for j in range(k + 1, p + right)]
        parts.append(f"{name}{k} AS (SELECT {', '.join([*keep, *cols])} FROM {prev})")
        prev = f"{name}{k}"
    return ",\n".join(parts)


def _gram_columns(p: int) -> list[str]:
    return [f"a_{i}_{j}" for i in range(p) for j in range(p + 1)]


def sql_kfold_regression(name: str, rows: str, xs: list[str], y: str) -> str:
    """CTEs up to ``name``_k: (fold, n_test, r2, mse, b0 ..) of least squares with intercept, each fold held out once.

    ``rows`` is a CTE with ``fold``, the columns ``xs`` and ``y``.
    """
    p = len(xs) + 1
    terms = ["1.0", *xs]
    sums = [f"sum({terms[i]} * {terms[j] if j < p else y}) AS a_{i}_{j}" for i in range(p) for j in range(p + 1)]
    cols = _gram_columns(p)
    fit = " + ".join(f"a_{i}_{p} * {t}" for i, t in enumerate(terms))
    return ",\n".join([
        f"{name}_g AS MATERIALIZED (SELECT fold, {', '.join(sums)} FROM {rows} GROUP BY fold)",
        f"{name}_t AS MATERIALIZED (SELECT {', '.join(f'sum({c}) AS {c}' for c in cols)} FROM {name}_g)",
        f"{name}_r AS MATERIALIZED (SELECT fold, {', '.join(f'{name}_t.{c} - {name}_g.{c} AS {c}' for c in cols)} FROM {name}_g, {name}_t)",
        sql_eliminate(f"{name}_r", f"{name}_e", p, 1, ("fold",)),
        f"{name}_b AS MATERIALIZED (SELECT * FROM {name}_e{p - 1})",
        f"{name}_k AS (SELECT fold, count(*) AS n_test, 1 - sum(pow({y} - ({fit}), 2)) / (var_pop({y}) * count(*)) AS r2, "
        f"sum(pow({y} - ({fit}), 2)) / count(*) AS mse, {', '.join(f'any_value(a_{i}_{p}) AS b{i}' for i in range(p))} "
        f"FROM {rows} JOIN {name}_b USING (fold) GROUP BY fold)"])
