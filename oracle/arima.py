"""Oracle SQL of the ARIMA and SARIMA panels: the two regressions by recursion over elimination steps and months."""

from __future__ import annotations

FALL = "PARTITION BY series ORDER BY t"


def eliminated(name: str, source: str, k: int) -> dict[str, str]:
    """``{name}(series, c)``: the solution of k equations in the list ``m`` of rows with the right side last."""
    return {
        f"{name}_g": f"""SELECT series, m, m AS was, 1 AS i FROM {source}
          UNION ALL SELECT series, list_transform(m, lambda row, j: CASE WHEN j = i THEN own ELSE
            list_transform(row, lambda x, z: x - row[i] * own[z]) END), was, i + 1
          FROM (SELECT *, list_transform(m[i], lambda x: CASE WHEN m[i][i] > 1e-9 * was[i][i] THEN x / m[i][i] ELSE 0 END) AS own
                FROM {name}_g WHERE i <= {k})""",
        name: f"SELECT series, list_transform(m, lambda row: row[{k + 1}]) AS c FROM {name}_g WHERE i = {k + 1}",
    }


def sums(xs: list[str], y: str) -> str:
    return "[" + ", ".join("[" + ", ".join(f"sum({a} * {b})" for b in [*xs, y]) + "]" for a in xs) + "]"


def lags(column: str, prefix: str, ks: tuple[int, ...]) -> str:
    return ", ".join(f"lag({column}, {k}) OVER ({FALL}) AS {prefix}{k}" for k in ks)


def staged(n: str, least: int, change: str, ks: tuple[int, ...], later: tuple[int, ...]) -> dict[str, str]:
    """Rows with lags of the change w and of the first stage's residual e, ``full`` where the regressions apply."""
    names = [f"l{k}" for k in ks]
    said = " + ".join(f"c[{i}] * {x}" for i, x in enumerate(names, 1))
    return {
        f"{n}_d": f"""SELECT * FROM (SELECT series, month, revenue, row_number() OVER w AS t, count(*) OVER (PARTITION BY series) AS n, {change} AS w
          FROM {n.split('_')[0]}_train WINDOW w AS (PARTITION BY series ORDER BY month)) WHERE n >= {least}""",
        f"{n}_l": f"SELECT *, {lags('w', 'l', ks)} FROM {n}_d",
        f"{n}_m": f"SELECT series, {sums(names, 'w')} AS m FROM {n}_l WHERE {names[-1]} IS NOT NULL GROUP BY series",
        **eliminated(f"{n}_long", f"{n}_m", len(ks)),
        f"{n}_e": f"SELECT l.*, CASE WHEN {names[-1]} IS NULL THEN 0 ELSE w - ({said}) END AS e FROM {n}_l l JOIN {n}_long USING (series)",
        f"{n}_r": f"SELECT *, {lags('e', 'e', later)} FROM {n}_e QUALIFY {names[-1]} IS NOT NULL",
    }


def ahead(n: str, fitted: str, y: int, e: int) -> dict[str, str]:
    """Forecasts from lists ``ar`` and ``ma`` of weights by lag, the last y values and e residuals, latest first."""
    dot = lambda a, b: f"list_sum(list_transform({a}, lambda x, i: x * {b}[i]))"
    return {
        f"{n}_tail": f"""SELECT series, max(month) AS final, list(revenue ORDER BY t DESC)[1:{y}] AS y, list(e ORDER BY t DESC)[1:{e}] AS e
          FROM {n}_e GROUP BY series""",
        f"{n}_go": f"""SELECT series, final, ar, ma, sigma2, 0 AS h, y, e, CAST(NULL AS DOUBLE) AS f,
            list_transform(ar, lambda x, i: CASE WHEN i = 1 THEN 1.0::DOUBLE ELSE 0 END) AS psi, CAST(0 AS DOUBLE) AS var
          FROM {fitted} JOIN {n}_tail USING (series)
          UNION ALL SELECT series, final, ar, ma, sigma2, h + 1, list_prepend(g, y[:{y - 1}]), list_prepend(CAST(0 AS DOUBLE), e[:{e - 1}]), g,
            list_prepend({dot('ar', 'psi')} + coalesce(ma[h + 1], 0), psi[:{y - 1}]), var + psi[1] * psi[1]
          FROM (SELECT *, {dot('ar', 'y')} + {dot('ma', 'e')} AS g FROM {n}_go WHERE h < 12)""",
        f"{n}_out": f"""SELECT series, CAST(final + to_months(CAST(h AS INT)) AS DATE) AS month, f,
          f - 1.96 * sqrt(sigma2 * var) AS low, f + 1.96 * sqrt(sigma2 * var) AS high FROM {n}_go WHERE h > 0""",
    }


def hold(x: str) -> str:
    return f"greatest(-0.99, least(0.99, {x}))"


def plain(n: str) -> dict[str, str]:
    """(2, 1, 2) as ``{n}_out``."""
    xs = ["l1", "l2", "e1", "e2"]
    return {
        **staged(n, 24, "revenue - lag(revenue) OVER w", (1, 2, 3, 4, 5), (1, 2)),
        f"{n}_q": f"SELECT series, {sums(xs, 'w')} AS m FROM {n}_r GROUP BY series",
        **eliminated(f"{n}_short", f"{n}_q", 4),
        f"{n}_c": f"""SELECT series, {hold('c[1] / (1 - p2)')} * (1 - p2) AS p1, p2, c[3] AS q1, c[4] AS q2
          FROM (SELECT *, {hold('c[2]')} AS p2 FROM {n}_short)""",
        f"{n}_s": f"""SELECT series, sum((w - p1 * l1 - p2 * l2 - q1 * e1 - q2 * e2) ** 2) / (count(*) - 4) AS sigma2
          FROM {n}_r JOIN {n}_c USING (series) GROUP BY series""",
        f"{n}_f": f"SELECT series, [1 + p1, p2 - p1, -p2] AS ar, [q1, q2] AS ma, sigma2 FROM {n}_c JOIN {n}_s USING (series)",
        **ahead(n, f"{n}_f", 3, 2),
    }


NAMES = ("w", "l1", "l12", "l13", "e1", "e12", "e13")


def inner(p: dict[str, str], q: dict[str, str]) -> str:
    """Inner product of two combinations, from the 7 x 7 list of sums g."""
    return "(" + " + ".join(f"({x}) * ({y}) * g[{NAMES.index(a) + 1}][{NAMES.index(b) + 1}]" for a, x in p.items() for b, y in q.items()) + ")"


def two(target: dict[str, str], one: dict[str, str], other: dict[str, str], source: str, keep: str, names: tuple[str, str]) -> str:
    """Least squares on two combinations, held below 1: a subquery with the two weights."""
    return f"""SELECT {keep}, {hold('coalesce((x - b * second) / nullif(a, 0), 0)')} AS {names[0]}, {hold('second')} AS {names[1]} FROM
      (SELECT *, CASE WHEN rest > 1e-9 * c THEN (y - coalesce(b * x / nullif(a, 0), 0)) / rest ELSE 0 END AS second FROM
       (SELECT *, c - coalesce(b * b / nullif(a, 0), 0) AS rest FROM
        (SELECT *, {inner(one, one)} AS a, {inner(one, other)} AS b, {inner(other, other)} AS c, {inner(one, target)} AS x,
           {inner(other, target)} AS y FROM {source})))"""


def seasonal(n: str) -> dict[str, str]:
    """(1, 1, 1)(1, 1, 1, 12) as ``{n}_out``."""
    change = "revenue - lag(revenue) OVER w - lag(revenue, 12) OVER w + lag(revenue, 13) OVER w"
    regular = two({"w": "1", "l12": "-sp", "e12": "-sq"}, {"l1": "1", "l13": "-sp"}, {"e1": "1", "e13": "sq"},
                  f"(SELECT * FROM {n}_turn WHERE k < 30)", "series, g, k", ("p", "q"))
    yearly = two({"w": "1", "l1": "-p", "e1": "-q"}, {"l12": "1", "l13": "-p"}, {"e12": "1", "e13": "q"}, f"({regular})",
                 "series, g, k, p, q", ("sp", "sq"))
    gram = "[" + ", ".join("[" + ", ".join(f"sum({a} * {b})" for b in NAMES) + "]" for a in NAMES) + "]"
    zero = "CAST(0 AS DOUBLE)"
    gap = ", ".join(["0.0"] * 9)
    return {
        **staged(n, 36, change, (1, 2, 12, 13), (1, 12, 13)),
        f"{n}_q": f"SELECT series, {gram} AS g FROM {n}_r GROUP BY series",
        f"{n}_turn": f"""SELECT series, g, 0 AS k, {zero} AS p, {zero} AS q, {zero} AS sp, {zero} AS sq FROM {n}_q
          UNION ALL SELECT series, g, k + 1, p, q, sp, sq FROM ({yearly})""",
        f"{n}_c": f"SELECT * FROM {n}_turn WHERE k = 30",
        f"{n}_s": f"""SELECT series, sum((w - p * l1 - sp * l12 + p * sp * l13 - q * e1 - sq * e12 - q * sq * e13) ** 2) / (count(*) - 4) AS sigma2
          FROM {n}_r JOIN {n}_c USING (series) GROUP BY series""",
        f"{n}_f": f"""SELECT series, [1 + p, -p, {gap}, 1 + sp, -(1 + sp) * (1 + p), p * (1 + sp), {gap}, -sp, sp * (1 + p), -p * sp]::DOUBLE[] AS ar,
          [q, {gap}, 0.0, sq, q * sq]::DOUBLE[] AS ma, sigma2 FROM {n}_c JOIN {n}_s USING (series)""",
        **ahead(n, f"{n}_f", 26, 13),
    }
