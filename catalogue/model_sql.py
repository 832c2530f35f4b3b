"""The year-effects model in SQL: cross products about the year means, solved by sweeping.

Independent of the library, which keeps the year effects as columns and solves on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from catalogue import oracles as O

ALIAS = 1e-11


def _entry(i: int, j: int) -> str:
    return f"s_{min(i, j)}_{max(i, j)}"


def fit_blocks(source: str, k: int, tag: str) -> dict[str, str]:
    """Blocks ``g`` (year means), ``v`` (solution, one row) and ``i`` (rows with influence measures).

    ``source`` has y, w, year and x1 to xk. In ``v`` the entries s_j_j are minus the inverse cross
    products, s_j_{k+1} the slopes and the last one the residual sum of squares; a regressor that
    depends on earlier ones is left out (``a_j`` is true).
    """
    xs = [f"x{j}" for j in range(1, k + 1)]
    z = [*[f"({x} - m{x})" for x in xs], "(y - my)"]
    means = ", ".join(f"sum(w * {c}) / sum(w) AS m{c}" for c in [*xs, "y"])
    sums = ", ".join(
        f"sum(w * {z[i]} * {z[j]}) AS {_entry(i + 1, j + 1)}" for i in range(k + 1) for j in range(i, k + 1)
    )
    start = ", ".join(f"{_entry(j, j)} AS d_{j}" for j in range(1, k + 1))
    blocks = {
        f"mz_g{tag}": f"SELECT year, sum(w) AS sw, {means} FROM {source} GROUP BY year",
        f"mz_c{tag}": f"""
SELECT *, {start} FROM (
  SELECT count(*) AS n, count(DISTINCT year) AS years, sum(w) AS sw, sum(w * y) / sum(w) AS y_mean,
    sum(w * y * y) - sum(w * y) * sum(w * y) / sum(w) AS tss, {sums}
  FROM {source} JOIN mz_g{tag} USING (year)) t""",
    }
    last = f"mz_c{tag}"
    for p in range(1, k + 1):
        changed, pivot = [], _entry(p, p)
        for i in range(1, k + 2):
            for j in range(i, k + 2):
                if i == j == p:
                    new = f"-1 / {pivot}"
                elif p in (i, j):
                    new = f"{_entry(i, j)} / {pivot}"
                else:
                    new = f"{_entry(i, j)} - {_entry(i, p)} * {_entry(p, j)} / {pivot}"
                changed.append(f"CASE WHEN {pivot} > {ALIAS} * d_{p} THEN {new} ELSE {_entry(i, j)} END AS {_entry(i, j)}")
        blocks[f"mz_s{p}{tag}"] = (
            f"SELECT * REPLACE ({', '.join(changed)}), NOT {pivot} > {ALIAS} * d_{p} AS a_{p} FROM {last}"
        )
        last = f"mz_s{p}{tag}"

    def kept(j: int, value: str) -> str:
        return f"CASE WHEN a_{j} THEN 0 ELSE {value} END"

    slopes = ", ".join(f"{kept(j, _entry(j, k + 1))} AS b_{j}" for j in range(1, k + 1))
    inverse = ", ".join(
        f"CASE WHEN a_{i} OR a_{j} THEN 0 ELSE -{_entry(i, j)} END AS v_{i}_{j}"
        for i in range(1, k + 1) for j in range(i, k + 1)
    )
    rank = " + ".join(f"CASE WHEN a_{j} THEN 0 ELSE 1 END" for j in range(1, k + 1))
    blocks[f"mz_v{tag}"] = f"""
SELECT *, rss / (n - rank) AS s2, {k} + years AS p FROM (
  SELECT *, {slopes}, {inverse}, {_entry(k + 1, k + 1)} AS rss, {rank} + years AS rank FROM {last}) t"""
    quad = " + ".join(
        f"{1 if i == j else 2} * v_{i}_{j} * {z[i - 1]} * {z[j - 1]}"
        for i in range(1, k + 1) for j in range(i, k + 1)
    )
    line = " + ".join(f"b_{j} * {z[j - 1]}" for j in range(1, k + 1))
    blocks[f"mz_i{tag}"] = f"""
SELECT *, r * sqrt((n - rank - 1) / (n - rank - r * r)) AS stud, r * r * hat / ((1 - hat) * rank) AS cook FROM (
  SELECT *, sqrt(w) * e / sqrt(s2 * (1 - hat)) AS r FROM (
    SELECT {', '.join(xs)}, y, w, year, n, rank, p, s2, y - my - ({line}) AS e, w * (1 / g.sw + {quad}) AS hat
    FROM {source} JOIN mz_g{tag} g USING (year), mz_v{tag} v) t) u"""
    return blocks


def trimmed_blocks(source: str, k: int, rounds: int) -> dict[str, str]:
    """``fit_blocks`` for the first fit (tag 0) and after each round of trimming (tags 1, 2, ...)."""
    blocks = {}
    for t in range(rounds + 1):
        blocks |= fit_blocks(source if t == 0 else f"mz_d{t}", k, f"_{t}")
        columns = ", ".join(f"x{j}" for j in range(1, k + 1))
        blocks[f"mz_d{t + 1}"] = f"""
SELECT {columns}, y, w, year FROM mz_i_{t}
WHERE stud < 2 AND cook < 4.0 / (n - p - 1) AND hat < 2.0 * p / n AND hat <= 1 - 1e-8"""
    return blocks


def coefficient_sql(fit: int, names: Sequence[str], tag: str) -> str:
    """Estimates and errors of regressors and intercept, estimates of the year effects."""
    k = len(names)
    at_base = " + ".join(f"b_{j} * z.mx{j}" for j in range(1, k + 1))
    at_year = " + ".join(f"b_{j} * g.mx{j}" for j in range(1, k + 1))
    quad = " + ".join(
        f"{1 if i == j else 2} * v_{i}_{j} * mx{i} * mx{j}" for i in range(1, k + 1) for j in range(i, k + 1)
    )
    base = f"(SELECT * FROM mz_g{tag} WHERE year = (SELECT min(year) FROM mz_g{tag}))"
    parts = [
        f"SELECT {fit} AS fit, '(Intercept)' AS term, {O.val(f'my - ({at_base})')} AS estimate,"
        f" {O.val(f'sqrt(s2 * (1 / z.sw + {quad}))')} AS std_error, n, {O.val('1 - rss / tss')} AS r_squared"
        f" FROM mz_v{tag} v, {base} z"
    ]
    for j, name in enumerate(names, 1):
        parts.append(
            f"SELECT {fit}, '{name}', CASE WHEN NOT a_{j} THEN {O.val(f'b_{j}')} END,"
            f" CASE WHEN NOT a_{j} THEN {O.val(f'sqrt(s2 * v_{j}_{j})')} END, n, {O.val('1 - rss / tss')} FROM mz_v{tag}"
        )
    parts.append(
        f"SELECT {fit}, 'year' || g.year, {O.val(f'(g.my - ({at_year})) - (z.my - ({at_base}))')}, NULL, n,"
        f" {O.val('1 - rss / tss')} FROM mz_v{tag} v, mz_g{tag} g, {base} z WHERE g.year <> z.year"
    )
    return " UNION ALL ".join(parts)


def imputation_blocks(predictor: str, divisor: str) -> dict[str, str]:
    """The blocks from the fitted ratio to the harmonised table, for another model.

    ``predictor`` is the linear predictor on the rows of ``predictors`` (alias p).
    """
    import re

    names = ["fitted", "labelled", "imputed", "zero_exporters", "final", "harmonised"]
    blocks = {"fitted_m": f"SELECT p.*, exp({predictor}) AS fitted_unit_ratio FROM predictors p"}
    for name in names[1:]:
        body = re.sub(rf"\b(FROM|JOIN)\s+({'|'.join(names)})\b", r"\1 \2_m", O.CTES[name])
        blocks[f"{name}_m"] = re.sub(r"\(1 \+ [0-9.]+\)", f"({divisor})", body)
    return blocks
