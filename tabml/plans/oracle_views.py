"""The input views of :mod:`tabml.sources.views`, as SQL for the oracle side."""

BLOCKS = """blocks AS (
  SELECT o_orderkey, o_orderpriority, o_totalprice, year(o_orderdate)::INTEGER AS o_year, c_acctbal,
         n_lines, total_qty, total_ext
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS total_qty,
                    sum(l_extendedprice) AS total_ext
             FROM lineitem GROUP BY l_orderkey) per_order ON l_orderkey = o_orderkey
)"""

# Blocks that have a label.
LABELLED = f"""{BLOCKS}, labelled AS (SELECT * FROM blocks WHERE total_ext IS NOT NULL)"""

LINES = """lines AS (
  SELECT *, CASE WHEN l_quantity + 5 * l_linenumber > 45 THEN 1.0 ELSE 0.0 END::DOUBLE AS label
  FROM lineitem
)"""


def position(key: str, salt: str = "") -> str:
    """The hash position of a key, see ``tabml.functions.hash_position``."""
    return f"('0x' || substr(md5('{salt}' || {key}::VARCHAR), 1, 6))::BIGINT"


def in_train(key: str, fraction: float = 0.8) -> str:
    return f"{position(key)} < {int(fraction * (1 << 24))}"


def fold(key: str, folds: int = 3) -> str:
    return f"{position(key, 'fold:')} % {folds}"
