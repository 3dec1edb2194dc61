"""Quality classifier from weak labels: labellers' accuracies by EM, then a hashed scorer."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import arrow_map, bound_batches, col, give_back
from tabml.sources.staging import stage

#: Cells of the hashed weights.
CELLS = 2**12
#: Most texts that train the scorer, half of them from each side of the posterior.
TRAINING_ROWS = 4000
#: Word shapes a worker remembers.
REMEMBERED = 100_000

GOOD, BAD, ABSTAIN = 1, 2, 0


def statistics(words: list[str], text: str) -> dict[str, float]:
    """What the labellers look at. ``words`` are the text's words, at least one."""
    n, size = len(words), len(text)
    letters = sum(map(str.isalpha, words))
    joined = "".join(words)
    symbols = len(joined) - sum(map(len, re.findall(r"\w+", joined)))
    upper = sum(map(str.isupper, words))
    lines = [line for line in text.split("\n") if line.strip()]
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return {
        "plain": letters / n,
        "symbols": symbols / max(1, len(joined)),
        "upper": upper / n,
        "distinct": len(set(words)) / n**0.9,
        "repeats": repeats / n,
        "same_lines": 1 - len(set(lines)) / max(1, len(lines)),
        "length": len(joined) / n,
        "spaces": 1 - len(joined) / max(1, size),
        "bare": sum(map("|".__eq__, words)) / n,
    }


#: Labellers: statistic, then the bounds below which and above which a text is good or bad.
#: Between the bounds they abstain. They overlap on purpose; EM finds how far to trust each.
LABELLERS: list[tuple[str, float, float]] = [
    # name, good at most, bad at least
    ("symbols", 0.08, 0.14),
    ("upper", 0.10, 0.30),
    ("repeats", 0.03, 0.15),
    ("same_lines", 0.30, 0.60),
    ("bare", 0.01, 0.10),
    ("marks", 0.10, 0.40),
    ("crowded", 0.60, 0.85),
    ("shouting", 0.08, 0.30),
]


def votes(words: list[str], text: str, seen: dict[str, float]) -> list[int]:
    """Each labeller's vote."""
    n = len(words)
    odd = sum(1 for w in words if len(w) > 1 and not w[-1].isalnum() and not w[-2].isalnum())
    top = max(Counter(words).values()) if n >= 8 else 0
    values = {
        **seen,
        "marks": odd / n,
        "crowded": top / n + (1 - len(set(words)) / n if n >= 20 else 0.0) / 2,
        "shouting": text.count("!") / n,
    }
    return [
        GOOD if values[name] <= good else BAD if values[name] >= bad else ABSTAIN
        for name, good, bad in LABELLERS
    ]


def shape(word: str) -> str:
    """Letters as x or X, digits as 9, runs shortened; marks stay."""
    out = []
    for character in word:
        kind = "X" if character.isupper() else "x" if character.isalpha() else "9" if character.isdigit() else character
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


def _cell(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % CELLS


class Features:
    """Hashed features of a text: its words' shapes by share, its statistics by step."""

    def __init__(self) -> None:
        self.cells: dict[str, int] = {}

    def __call__(self, words: list[str], seen: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
        cells = self.cells
        missing = set(words).difference(cells)
        if len(cells) + len(missing) > REMEMBERED:
            cells.clear()
            missing = set(words)
        for word in missing:
            cells[word] = _cell("shape " + shape(word))
        place, n = np.unique(np.fromiter(map(cells.__getitem__, words), np.int32, len(words)), return_counts=True)
        steps = [_cell(f"{name} {round(value * 12)}") for name, value in sorted(seen.items()) if name != "length"]
        places = np.concatenate([place, np.array(steps, place.dtype)])
        return places, np.concatenate([np.sqrt(n / len(words)), np.full(len(steps), 0.5)])


@dataclass
class LabelModel:
    """How labellers vote for a good and for a bad text, and the share of good ones."""

    prior: float
    rates: np.ndarray  # side (bad, good), labeller, vote

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """The probability of good for each row of votes. A text nobody votes on has the prior."""
        logs = np.zeros((2, len(patterns)))
        for labeller in range(patterns.shape[1]):
            logs += np.log(self.rates[:, labeller, :])[:, patterns[:, labeller]]
        logs += np.log([[1 - self.prior], [self.prior]])
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> LabelModel:
    """Accuracies of the labellers from how they agree, without any true label.

    ``patterns`` are the distinct rows of votes and ``counts`` how many texts have each. It
    starts with every text that any labeller calls bad as bad, and smooths each rate by one vote.
    """
    good = (patterns == GOOD).sum(axis=1) - 20.0 * (patterns == BAD).sum(axis=1)
    belief = 1 / (1 + np.exp(-good))
    model = LabelModel(0.5, np.full((2, patterns.shape[1], 3), 1 / 3))
    for _ in range(rounds):
        prior = (counts @ belief + 1) / (counts.sum() + 2)
        rates = np.ones((2, patterns.shape[1], 3))
        for vote in range(3):
            hit = patterns == vote
            rates[1, :, vote] += (counts * belief) @ hit
            rates[0, :, vote] += (counts * (1 - belief)) @ hit
        model = LabelModel(float(prior), rates / rates.sum(axis=2, keepdims=True))
        new = model.posterior(patterns)
        if np.abs(new - belief).max() < 1e-9:
            break
        belief = new
    return model


def _pattern(codes: np.ndarray) -> np.ndarray:
    """Rows of votes from their base-3 codes."""
    return np.stack([codes // 3**k % 3 for k in range(len(LABELLERS))], axis=1)


def _code(own: list[int]) -> int:
    return sum(vote * 3**k for k, vote in enumerate(own))


def vote_codes(rows: DataFrame) -> DataFrame:
    """``id, code``: each row's votes as one number; null for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            codes = []
            for text in rows["text"].to_pylist():
                words = text.split()
                codes.append(_code(votes(words, text, statistics(words, text))) if words else None)
            yield pa.RecordBatch.from_arrays([rows["id"], pa.array(codes, pa.int32())], names=["id", "code"])

    return arrow_map(rows.select("id", "text"), run, "id long, code int")


@dataclass
class Scorer:
    """A logistic scorer over hashed features."""

    weights: np.ndarray
    bias: float

    def __call__(self, places: np.ndarray, values: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[places] @ values + self.bias, -30, 30))))


def train(examples: list[tuple[np.ndarray, np.ndarray]], targets: np.ndarray, weights: np.ndarray) -> Scorer:
    """Logistic regression on soft targets: full gradients with momentum, a light penalty."""
    if not len(examples):
        return Scorer(np.zeros(CELLS), 0.0)
    matrix = np.zeros((len(examples), CELLS), np.float32)
    for row, (places, values) in enumerate(examples):
        np.add.at(matrix[row], places, values)
    used = np.flatnonzero(matrix.any(axis=0))
    matrix = matrix[:, used].astype(np.float64)
    share = weights / weights.sum()
    slope, bias = np.zeros(len(used)), 0.0
    speed, bias_speed = np.zeros(len(used)), 0.0
    for _ in range(600):
        error = share * (1 / (1 + np.exp(-np.clip(matrix @ slope + bias, -30, 30))) - targets)
        speed = 0.9 * speed + matrix.T @ error + 1e-5 * slope
        bias_speed = 0.9 * bias_speed + error.sum()
        slope -= 1.0 * speed
        bias -= 1.0 * bias_speed
    out = np.zeros(CELLS)
    out[used] = slope
    return Scorer(out, float(bias))


def _rows(docs: DataFrame, text: str, key: str) -> DataFrame:
    return docs.select(
        col(key).cast("long").alias("id"), F.coalesce(col(text).cast("string"), F.lit("")).alias("text")
    )


def fit(docs: DataFrame, text: str = "text", key: str = "doc_id") -> tuple[LabelModel | None, Scorer]:
    """Label model over all rows, scorer over a bounded sample of them.

    The label model sees every row: rows with the same votes are counted together, 3**8 kinds
    at most. The scorer learns from ``TRAINING_ROWS`` texts, half of them (or all there are)
    with a posterior below one half, picked by the hash of their ids.

    Null and empty texts and texts without words have no votes and train nothing, as do rows
    with a null key; texts are read whole. Equal votes are counted together, so ties and
    repeated rows weigh as often as they are there; of rows of one key one trains. Columns of
    other names are ignored. An empty table gives no label model and a scorer of one half.
    """
    rows = _rows(docs, text, key)
    codes = stage(vote_codes(rows), "votes").filter("code is not null")
    table = codes.groupBy("code").agg(F.count("*").alias("n")).orderBy("code").toPandas()
    if not len(table):
        return None, Scorer(np.zeros(CELLS), 0.0)
    patterns = _pattern(table["code"].to_numpy())
    model = expectation_maximisation(patterns, table["n"].to_numpy().astype(float))
    belief = model.posterior(patterns)
    spark = docs.sparkSession
    sides = spark.createDataFrame(pd.DataFrame({"code": table["code"].astype("int32"), "belief": belief}))
    voted = codes.filter("id is not null").join(F.broadcast(sides), "code").select("id", "belief")
    half = TRAINING_ROWS // 2
    order = F.xxhash64("id")
    low = voted.filter("belief < 0.5").orderBy(order, "id").limit(half)
    high = voted.filter("belief >= 0.5").orderBy(order, "id").limit(half)
    picked = low.union(high).toPandas().drop_duplicates("id")
    keys = spark.createDataFrame(picked[["id"]].astype("int64")) if len(picked) else None
    texts = rows.join(F.broadcast(keys), "id", "left_semi") if keys is not None else rows.limit(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for rows in batches:
            kept = [(i, t) for i, t in zip(rows["id"].to_pylist(), rows["text"].to_pylist(), strict=True) if t.split()]
            found = [features(t.split(), statistics(t.split(), t)) for _, t in kept]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i for i, _ in kept], pa.int64()),
                    pa.array([p.astype(np.int32) for p, _ in found], pa.list_(pa.int32())),
                    pa.array([v for _, v in found], pa.list_(pa.float64())),
                ],
                names=["id", "places", "values"],
            )

    sample = arrow_map(texts, run, "id long, places array<int>, values array<double>").toPandas()
    sample = sample.drop_duplicates("id").sort_values("id")
    target = dict(zip(picked["id"], picked["belief"], strict=True))
    targets = np.array([target[i] for i in sample["id"]])
    # Both sides weigh alike, whatever their numbers.
    sides = np.where(targets < 0.5, max(1, (targets < 0.5).sum()), max(1, (targets >= 0.5).sum()))
    examples = [
        (np.asarray(p), np.asarray(v)) for p, v in zip(sample["places"], sample["values"], strict=True)
    ]
    return model, train(examples, targets, 1 / sides)


def score_column(docs: DataFrame, scorer: Scorer, text: str = "text"):  # noqa: ANN201
    """A column with each text's score: the probability of good, 0 without words (null, empty, blank).

    It depends on the whole text alone: equal texts have equal scores, and no other column of
    ``docs``, whatever its name, is read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    bound_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features, own = Features(), shared.value
        for series in texts:
            out = []
            for text in series:
                words = text.split()
                out.append(own(*features(words, statistics(words, text))) if words else 0.0)
            yield pd.Series(out, dtype="float64")
        give_back()

    return score(F.coalesce(col(text).cast("string"), F.lit("")))
