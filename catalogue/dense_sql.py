"""Regressions in SQL with a column per level, solved by elimination on matrices held as nested lists.

Independent of the library, which keeps effects apart or absorbs them. A matrix block has the columns
``g`` (a key), ``p`` (its rows) and ``m`` (rows of the matrix, right-hand sides after the p columns).
"""

from __future__ import annotations

from collections.abc import Sequence

from catalogue import oracles as O

ALIAS = 1e-11


def eliminated(matrix: str) -> str:
    """``matrix`` with its left part reduced to the identity; a pivot left without length is passed over."""
    return f"""
SELECT g, p, m, list_transform(range(1, p + 1), lambda i: abs(m[i][i] - 1) < 1e-6) AS kept FROM (
  WITH RECURSIVE steps AS (
    SELECT g, p, 1 AS k, m, list_transform(range(1, p + 1), lambda i: m[i][i]) AS d FROM {matrix}
    UNION ALL
    SELECT g, p, k + 1, CASE WHEN m[k][k] > {ALIAS} * d[k] AND d[k] > 0 THEN list_transform(m, lambda r, i: CASE WHEN i = k
      THEN list_transform(r, lambda v: v / r[k]) ELSE list_transform(r, lambda v, j: v - r[k] * m[k][j] / m[k][k]) END)
      ELSE list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v, j: CASE WHEN j = k THEN 0 ELSE v END) ELSE r END) END, d
    FROM steps WHERE k <= p
  ) SELECT * FROM steps WHERE k = p + 1) t"""


def _matrix(columns: Sequence[str], weight: str, right: str) -> str:
    """Cross products, the identity, and the products with ``right``."""
    rows = []
    for i, a in enumerate(columns):
        unit = [f"{float(i == j)!r}" for j in range(len(columns))]
        rows.append("[" + ", ".join([f"sum({weight} * {a} * {b})" for b in columns] + unit + [f"sum({right} * {a})"]) + "]")
    return "[" + ", ".join(rows) + "]"


class Dense:
    """Models on a constant, regressors x1 to xk of ``source``, and a column per level of ``year`` but the first.

    Regressors are taken about their means in units of their deviation, as blocks ``mz_s`` and ``mz_r``.
    """

    def __init__(self, source: str, k: int, years: Sequence[int], tag: str, more: Sequence[str] = ()) -> None:
        self.k, self.tag, self.years = k, tag, list(years)
        self.columns = ["c0", *[f"c{j}" for j in range(1, k + 1)], *[f"d{y}" for y in self.years[1:]], *more]
        self.p = len(self.columns)
        stats = ", ".join(f"avg(x{j}) AS a{j}, stddev_pop(x{j}) AS s{j}" for j in range(1, k + 1))
        scaled = ", ".join(f"(x{j} - a{j}) / s{j} AS c{j}" for j in range(1, k + 1))
        level = ", ".join(f"CASE WHEN year = {y} THEN 1.0::DOUBLE ELSE 0.0 END AS d{y}" for y in self.years[1:])
        self.blocks = {
            f"mz_s{tag}": f"SELECT {stats} FROM {source}",
            f"mz_r{tag}": f"SELECT {source}.*, 1.0::DOUBLE AS c0, {scaled}, {level} FROM {source}, mz_s{tag}",
        }

    def index(self, t: str = "t") -> str:
        return " + ".join(f"{t}[{i}] * {c}" for i, c in enumerate(self.columns, 1))

    def least_squares(self, rows: str, weight: str, name: str) -> dict[str, str]:
        """Block ``mz_{name}``: coefficients ``t``, inverse ``inv``, ``n``, ``rank``, ``rss``, ``tss``."""
        p = self.p
        return {
            f"mz_{name}m": f"SELECT 0 AS g, {p} AS p, {_matrix(self.columns, weight, f'{weight} * y')} AS m FROM {rows}",
            f"mz_{name}e": eliminated(f"mz_{name}m"),
            f"mz_{name}t": f"""SELECT list_transform(range(1, {p + 1}), lambda i: CASE WHEN kept[i] THEN m[i][{2 * p + 1}] ELSE 0 END) AS t,
  list_transform(m, lambda r: r[{p + 1}:{2 * p}]) AS inv, kept, len(list_filter(kept, lambda v: v)) AS rank FROM mz_{name}e""",
            f"mz_{name}": f"""SELECT any_value(t) AS t, any_value(inv) AS inv, any_value(kept) AS kept, any_value(rank) AS rank, count(*) AS n,
  sum({weight} * (y - ({self.index()})) * (y - ({self.index()}))) AS rss,
  sum({weight} * y * y) - sum({weight} * y) * sum({weight} * y) / sum({weight}) AS tss FROM {rows}, mz_{name}t""",
        }

    def poisson(self, rows: str, name: str, steps: int = 9) -> dict[str, str]:
        """Block ``mz_{name}`` as above by Newton steps, with ``pearson`` and ``r`` (of response and fit)."""
        p, out = self.p, {}
        zeros = ", ".join(["0.0::DOUBLE"] * (p - 1))
        out[f"mz_{name}0"] = f"SELECT [ln(avg(y)), {zeros}] AS t FROM {rows}"
        for s in range(1, steps + 1):
            out[f"mz_{name}{s}m"] = f"""SELECT 0 AS g, {p} AS p, any_value(t) AS t, {_matrix(self.columns, 'mu', '(y - mu)')} AS m
FROM (SELECT {rows}.*, t, exp({self.index()}) AS mu FROM {rows}, mz_{name}{s - 1}) u"""
            out[f"mz_{name}{s}e"] = eliminated(f"mz_{name}{s}m")
            out[f"mz_{name}{s}"] = f"""SELECT list_transform(a.t, lambda v, i: v + CASE WHEN kept[i] THEN b.m[i][{2 * p + 1}] ELSE 0 END) AS t,
  list_transform(b.m, lambda r: r[{p + 1}:{2 * p}]) AS inv, kept, len(list_filter(kept, lambda v: v)) AS rank
FROM mz_{name}{s}m a, mz_{name}{s}e b"""
        out[f"mz_{name}"] = f"""SELECT any_value(t) AS t, any_value(inv) AS inv, any_value(kept) AS kept, any_value(rank) AS rank, count(*) AS n,
  sum((y - mu) * (y - mu) / mu) AS pearson, corr(y, mu) AS r
FROM (SELECT {rows}.*, t, inv, kept, rank, exp({self.index()}) AS mu FROM {rows}, mz_{name}{steps}) u"""
        return out

    def terms(self, name: str, names: Sequence[str], variance: str, model: str, p_value) -> str:
        """A row per term; ``variance`` is the error variance in terms of the block, ``p_value`` makes SQL of a statistic."""
        k, s = self.k, f"mz_s{self.tag}"
        shift = " - ".join(["t[1]", *[f"t[{j + 1}] * a{j} / s{j}" for j in range(1, k + 1)]])
        back = ["1.0", *[f"(-a{j} / s{j})" for j in range(1, k + 1)]]
        quad = " + ".join(f"{back[i]} * {back[j]} * inv[{i + 1}][{j + 1}]" for i in range(k + 1) for j in range(k + 1))
        rows = [f"SELECT '(Intercept)' AS term, {shift} AS b, sqrt({variance} * ({quad})) AS e, true AS kept, n, rank FROM mz_{name}, {s}"]
        for j, x in enumerate(names, 1):
            rows.append(f"SELECT '{x}', t[{j + 1}] / s{j}, sqrt({variance} * inv[{j + 1}][{j + 1}]) / s{j}, kept[{j + 1}], n, rank FROM mz_{name}, {s}")
        for j, y in enumerate(self.years[1:], k + 2):
            rows.append(f"SELECT 'year{y}', t[{j}], sqrt({variance} * inv[{j}][{j}]), kept[{j}], n, rank FROM mz_{name}")
        return f"""SELECT '{model}' AS model, term, CASE WHEN kept THEN {O.val('b')} END AS estimate, CASE WHEN kept THEN {O.val('e')} END AS std_error,
  CASE WHEN kept THEN {O.val('b / e', 4)} END AS statistic, CASE WHEN kept THEN {O.val(p_value('b / e', '(n - rank)'), 4)} END AS p_value
FROM ({' UNION ALL '.join(rows)}) t"""


# --- two effects within years, one column per level ---------------------------------------------


def two_effects(source: str, group: str, first: str, second: str, columns: Sequence[str], tag: str) -> dict[str, str]:
    """Block ``mz_o{tag}``: the rows of ``source`` with the weighted ``columns`` less their level values.

    Levels are those of ``first`` and ``second`` within ``group``; the matrix of each group has a column per level
    but the first of the second effect. ``source`` has the weight ``w``.
    """
    sums = ", ".join(f"sum(w * {c}) AS t{i}" for i, c in enumerate(columns))
    rhs = " UNION ALL ".join(f"SELECT g, i, p + {i + 1} AS j, t{i} AS v FROM mz_l{tag}" for i in range(len(columns)))
    parts = ", ".join(
        f"{c} - coalesce(e.m[a.i][e.p + {i + 1}], 0) - CASE WHEN b.i > e.p THEN 0 ELSE coalesce(e.m[b.i][e.p + {i + 1}], 0) END AS {c}"
        for i, c in enumerate(columns)
    )
    rest = f"SELECT * EXCLUDE ({', '.join(columns)}) FROM {source}"
    return {
        # the first level of the second effect comes last, beyond the p columns
        f"mz_k{tag}": f"""SELECT g, side, level, n1, row_number() OVER (PARTITION BY g ORDER BY side, CASE WHEN side = 2 AND f THEN 1 ELSE 0 END, level) AS i,
  count(*) OVER (PARTITION BY g) - 1 AS p FROM (
  SELECT g, side, level, 0 AS n1, row_number() OVER (PARTITION BY g, side ORDER BY level) = 1 AS f FROM (
    SELECT DISTINCT {group} AS g, 1 AS side, {first} AS level FROM {source}
    UNION SELECT DISTINCT {group}, 2, {second} FROM {source}) t) u""",
        f"mz_l{tag}": f"""SELECT k.g, k.i, k.p, sum(w) AS sw, {sums} FROM {source} s JOIN mz_k{tag} k
  ON k.g = s.{group} AND k.level = CASE WHEN side = 1 THEN s.{first} ELSE s.{second} END GROUP BY k.g, k.i, k.p""",
        f"mz_v{tag}": f"""SELECT g, i, i AS j, sw AS v FROM mz_l{tag} UNION ALL {rhs}
UNION ALL SELECT g, unnest([i, j]), unnest([j, i]), v FROM (
  SELECT a.g, a.i, b.i AS j, sum(w) AS v FROM {source} s
  JOIN mz_k{tag} a ON a.side = 1 AND a.g = s.{group} AND a.level = s.{first}
  JOIN mz_k{tag} b ON b.side = 2 AND b.g = s.{group} AND b.level = s.{second}
  WHERE b.i <= b.p GROUP BY a.g, a.i, b.i) t""",
        f"mz_m{tag}": f"""SELECT g, any_value(p) AS p, list(r ORDER BY i) AS m FROM (
  SELECT q.g, q.p, q.i, list(coalesce(v.v, 0)::DOUBLE ORDER BY q.j) AS r FROM (
    SELECT g, p, i, unnest(range(1, p + {len(columns) + 1})) AS j FROM mz_k{tag} WHERE i <= p) q
  LEFT JOIN mz_v{tag} v ON v.g = q.g AND v.i = q.i AND v.j = q.j GROUP BY q.g, q.p, q.i) t GROUP BY g""",
        f"mz_e{tag}": eliminated(f"mz_m{tag}"),
        f"mz_o{tag}": f"""SELECT s.* REPLACE ({parts}) FROM {source} s
JOIN mz_k{tag} a ON a.side = 1 AND a.g = s.{group} AND a.level = s.{first}
JOIN mz_k{tag} b ON b.side = 2 AND b.g = s.{group} AND b.level = s.{second}
JOIN mz_e{tag} e ON e.g = s.{group}""",
    }


def two_slopes(rows: str, y: str, more: str) -> str:
    """Slopes b1, b2 and inverse cross products v11, v22 of ``y`` on x1 and x2, without a constant."""
    return f"""SELECT *, (s1y * s22 - s2y * s12) / det AS b1, (s2y * s11 - s1y * s12) / det AS b2, s22 / det AS v11, s11 / det AS v22 FROM (
  SELECT *, s11 * s22 - s12 * s12 AS det FROM (
    SELECT sum(w * x1 * x1) AS s11, sum(w * x1 * x2) AS s12, sum(w * x2 * x2) AS s22, sum(w * x1 * {y}) AS s1y,
      sum(w * x2 * {y}) AS s2y, sum(w * {y} * {y}) AS syy, {more} FROM {rows}) a) b"""


def absorbed_poisson(source: str, group: str, first: str, second: str, steps: int = 9) -> dict[str, str]:
    """Block ``mz_pf``: slopes of x1 and x2 and the rows' fitted values in ``mz_pw``, by reweighted least squares."""
    out = {"mz_pw0": f"SELECT *, (y + (SELECT avg(y) FROM {source})) / 2 AS mu FROM {source}"}
    for s in range(1, steps + 1):
        tag = f"_p{s}"
        work = f"mz_pz{s}"
        out[work] = f"SELECT id, {group}, {first}, {second}, y, x1, x2, ln(mu) + (y - mu) / mu AS z, ln(mu) + (y - mu) / mu AS z0, x1 AS x10, x2 AS x20, mu AS w FROM mz_pw{s - 1}"
        out |= two_effects(work, group, first, second, ["x1", "x2", "z"], tag)
        out[f"mz_pb{s}"] = two_slopes(f"mz_o{tag}", "z", "count(*) AS n")
        out[f"mz_pw{s}"] = f"""SELECT id, {group}, {first}, {second}, y, x10 AS x1, x20 AS x2, exp(z0 - (z - b1 * o.x1 - b2 * o.x2)) AS mu
FROM mz_o{tag} o, mz_pb{s}"""
    return out
