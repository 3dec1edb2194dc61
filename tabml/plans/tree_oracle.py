"""Decision trees as SQL, for predictors with few distinct values.

A tree grown level by level is a chain of tables: the rows with their node, the
sums per node, predictor and value, the best cut per node, the rows with their next
node. Cuts lie midway between neighbouring values of the training rows.
"""

from __future__ import annotations

from collections.abc import Sequence


def _purity(sums: str, rows: str, kind: str) -> str:
    if kind == "variance":
        return f"({sums} * {sums} / {rows})"
    return f"(({sums} * {sums} + ({rows} - {sums}) * ({rows} - {sums})) / {rows})"


def tree_ctes(
    name: str,
    source: str,
    predictors: Sequence[str],
    depth: int,
    kind: str = "variance",
    label: str = "label",
    train: str = "is_train",
    min_rows: int = 1,
) -> list[str]:
    """Tables ``{name}_0`` to ``{name}_{depth}``: ``source`` with the row's ``node`` at that depth."""
    values = " UNION ALL ".join(
        f"SELECT {{node}}{i} AS f, {p}::DOUBLE AS q, {label} AS y FROM {{table}} WHERE {train}"
        for i, p in enumerate(predictors)
    )
    value = "CASE f " + " ".join(f"WHEN {i} THEN {p}" for i, p in enumerate(predictors)) + " END"
    ctes = [
        f"{name}_0 AS MATERIALIZED (SELECT *, 1::BIGINT AS node FROM {source})",
        f"""{name}_cuts AS MATERIALIZED (
  SELECT f, q, (q + lead(q) OVER (PARTITION BY f ORDER BY q)) / 2 AS cut
  FROM (SELECT DISTINCT f, q FROM ({values.format(node="", table=source)})))""",
    ]
    for level in range(depth):
        rows = f"{name}_{level}"
        left, right, whole = (_purity(s, n, kind) for s, n in (("sl", "nl"), ("sr", "nr"), ("s", "n")))
        ctes.append(f"""{name}_best_{level} AS MATERIALIZED (
  SELECT node, f, cut FROM (
    SELECT *, n - nl AS nr, s - sl AS sr FROM (
      SELECT node, f, q, sum(n) OVER upto AS nl, sum(s) OVER upto AS sl,
             sum(n) OVER (PARTITION BY node, f) AS n, sum(s) OVER (PARTITION BY node, f) AS s
      FROM (SELECT node, f, q, count(*)::DOUBLE AS n, sum(y) AS s
            FROM ({values.format(node="node, ", table=rows)}) GROUP BY node, f, q)
      WINDOW upto AS (PARTITION BY node, f ORDER BY q)))
  JOIN {name}_cuts USING (f, q)
  WHERE nl >= {min_rows} AND nr >= {min_rows} AND {left} + {right} > {whole} * (1 + 1e-12)
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY {left} + {right} DESC, f, cut) = 1)""")
        ctes.append(f"""{name}_{level + 1} AS MATERIALIZED (
  SELECT {rows}.* EXCLUDE (node),
         CASE WHEN cut IS NULL THEN {rows}.node
              WHEN {value} <= cut THEN 2 * {rows}.node ELSE 2 * {rows}.node + 1 END AS node
  FROM {rows} LEFT JOIN {name}_best_{level} USING (node))""")
    return ctes


def leaf_mean(label: str = "label", train: str = "is_train") -> str:
    return f"avg({label}) FILTER (WHERE {train}) OVER (PARTITION BY node)"


def boosted_ctes(
    name: str,
    source: str,
    predictors: Sequence[str],
    depth: int,
    rounds: int,
    step: float = 0.1,
    min_rows: int = 1,
) -> list[str]:
    """Tables ``{name}_round_{m}``: ``source`` with the prediction ``p`` after ``m`` trees.

    The first tree fits the label with weight 1; each later one fits the negative
    gradient of the squared error, twice the residual, with weight ``step``.
    """
    ctes = [f"{name}_round_0 AS MATERIALIZED (SELECT *, 0.0::DOUBLE AS p, label AS target FROM {source})"]
    for m in range(rounds):
        tree = f"{name}_tree_{m}"
        ctes += tree_ctes(tree, f"{name}_round_{m}", predictors, depth, label="target", min_rows=min_rows)
        weight = 1.0 if m == 0 else step
        ctes.append(f"""{name}_round_{m + 1} AS MATERIALIZED (
  SELECT * EXCLUDE (node, p, target, leaf), p + {weight}::DOUBLE * leaf AS p,
         2 * (label - (p + {weight}::DOUBLE * leaf)) AS target
  FROM (SELECT *, {leaf_mean("target")} AS leaf FROM {tree}_{depth}))""")
    return ctes
