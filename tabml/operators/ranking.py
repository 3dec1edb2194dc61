"""Running totals and exact medians over orders too long for one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabml.functions import missing_to_null, require_columns
from tabml.sources.staging import stage

# Rows, of all columns together, that one task may take for the last step of a median.
DIRECT_ROWS = 2_000_000
# percentile_approx is off by at most 1 / ACCURACY of the rows.
ACCURACY = 10_000


def running_totals(
    frame: DataFrame,
    order_by: Sequence[Column],
    totals: Mapping[str, Column],
    by: Sequence[str] = (),
) -> DataFrame:
    """Add, per ``by`` group, the sum of each total over the rows sorted before.

    A window over the whole order would run in one task. Instead the rows are
    range-sorted once and written with the number of their range; each range is
    then summed on its own, and gets the sum of the ranges before it added from a
    table that has at most one row per range.

    ``order_by`` must tell rows of a group apart, and callers group equal rows
    first, so no range can be filled by one repeated value.
    """
    by = list(by)
    terms = frame.select("*", *[value.alias(f"_term_{name}") for name, value in totals.items()])
    ordered = terms.orderBy(*by, *order_by).select(
        "*",
        F.spark_partition_id().alias("_range"),
        F.monotonically_increasing_id().alias("_position"),
    )
    staged = stage(ordered, "running-totals")

    before = (Window.unboundedPreceding, -1)
    within = Window.partitionBy("_range", *by).orderBy("_position").rowsBetween(*before)
    across = Window.partitionBy(*by).orderBy("_range").rowsBetween(*before)
    inner = staged.select(
        *frame.columns,
        "_range",
        *[F.coalesce(F.sum(f"_term_{n}").over(within), F.lit(0)).alias(f"_in_{n}") for n in totals],
    )
    offsets = (
        staged.groupBy("_range", *by)
        .agg(*[F.sum(f"_term_{n}").alias(f"_sum_{n}") for n in totals])
        .select(
            F.col("_range").alias("_at_range"),
            *[F.col(name).alias(f"_at_{name}") for name in by],
            F.row_number().over(Window.partitionBy(*by).orderBy("_range")).alias("_nth"),
            *[F.coalesce(F.sum(f"_sum_{n}").over(across), F.lit(0)).alias(f"_off_{n}") for n in totals],
        )
        .where("_nth > 1")
        .drop("_nth")
    )
    same = F.col("_range") == F.col("_at_range")
    for name in by:
        same = same & F.col(name).eqNullSafe(F.col(f"_at_{name}"))
    # The order starts with the group, so one group at most goes on across each range's start:
    # there are fewer offsets than ranges, however many groups there are.
    return inner.join(F.broadcast(offsets), same, "left").select(
        *frame.columns,
        *[(F.col(f"_in_{n}") + F.coalesce(F.col(f"_off_{n}"), F.lit(0))).alias(n) for n in totals],
    )


def exact_medians(
    frame: DataFrame, columns: Sequence[str], direct_rows: int = DIRECT_ROWS
) -> dict[str, float | None]:
    """The exact median of each column, the lower one of two; missing values do not count.

    Each round is an aggregate with a result of fixed size: approximate quantiles
    just below and above the wanted rank become the ends of an open interval, and
    the rows on and between the ends are counted. A rank on an end is answered; one
    between them leaves an interval that holds about 1/2500 of the rows before, so
    a handful of rounds suffice at any size. No data is shuffled, and a value that
    repeats any number of times is one end of an interval.
    """
    require_columns(frame, columns)
    values = frame.select(
        *[missing_to_null(frame, c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)]
    )
    counts = values.agg(*[F.count(f"v{i}").alias(f"v{i}") for i in range(len(columns))]).head()
    medians: dict[str, float | None] = {c: None for c in columns}
    # Per unsolved column: interval ends (None = open), rows inside, wanted rank inside.
    open_columns = {
        i: (None, None, counts[i], (counts[i] + 1) // 2) for i in range(len(columns)) if counts[i]
    }
    while open_columns:
        solved = _solve_small(values, open_columns, direct_rows // len(open_columns))
        for i, value in solved.items():
            medians[columns[i]] = value
            del open_columns[i]
        if open_columns:
            for i, outcome in _narrow(values, open_columns).items():
                if isinstance(outcome, float):
                    medians[columns[i]] = outcome
                    del open_columns[i]
                else:
                    open_columns[i] = outcome
    return medians


def _inside(i: int, low: float | None, high: float | None) -> Column:
    value = F.col(f"v{i}")
    condition = value.isNotNull()
    if low is not None:
        condition = condition & (value > low)
    if high is not None:
        condition = condition & (value < high)
    return F.when(condition, value)


def _solve_small(values: DataFrame, open_columns: dict, row_limit: int) -> dict[int, float]:
    small = {i: state for i, state in open_columns.items() if state[2] <= row_limit}
    if not small:
        return {}
    inside = values.select(*[_inside(i, small[i][0], small[i][1]).alias(f"v{i}") for i in small])
    row = inside.agg(
        *[
            # (rank - 1/2) / rows lies strictly between the neighbouring ranks.
            F.expr(
                f"percentile_disc({(rank - 0.5) / rows!r}D) WITHIN GROUP (ORDER BY v{i})"
            ).alias(f"v{i}")
            for i, (_, _, rows, rank) in small.items()
        ]
    ).head()
    return {i: row[f"v{i}"] for i in small}


def _narrow(values: DataFrame, open_columns: dict) -> dict:
    margin = 2 / ACCURACY
    ends = values.agg(
        *[
            F.percentile_approx(
                _inside(i, low, high),
                [max(0.0, rank / rows - margin), min(1.0, rank / rows + margin)],
                ACCURACY,
            ).alias(f"v{i}")
            for i, (low, high, rows, rank) in open_columns.items()
        ]
    ).head()
    row = values.agg(
        *[
            F.count_if(condition).alias(f"{name}{i}")
            for i, (low, high, _, _) in open_columns.items()
            for name, condition in (
                ("below", _inside(i, low, high) < ends[f"v{i}"][0]),
                ("low", F.col(f"v{i}") == ends[f"v{i}"][0]),
                ("between", _inside(i, *ends[f"v{i}"]).isNotNull()),
                ("high", F.col(f"v{i}") == ends[f"v{i}"][1]),
            )
        ]
    ).head()
    outcomes = {}
    for i, (low, high, rows, rank) in open_columns.items():
        first, last = ends[f"v{i}"]
        below, on_first, between = row[f"below{i}"], row[f"low{i}"], row[f"between{i}"]
        on_last = row[f"high{i}"] if last > first else 0
        upto_first, upto_last = below + on_first, below + on_first + between + on_last
        if rank <= below:
            outcomes[i] = (low, first, below, rank)
        elif rank <= upto_first:
            outcomes[i] = float(first)
        elif rank <= upto_first + between:
            outcomes[i] = (first, last, between, rank - upto_first)
        elif rank <= upto_last:
            outcomes[i] = float(last)
        else:
            outcomes[i] = (last, high, rows - upto_last, rank - upto_last)
    return outcomes
