"""Language identification by interpolated Kneser-Ney character models."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import arrow_map, col
from tabml.sources.staging import stage

#: Characters of a gram, and bits of a character's class: at most 2**24 grams a language.
ORDER, BITS = 4, 6
CLASSES = 2**BITS
#: Characters of text scored at once.
BLOCK = 400_000
#: Share of false rejections, and the precision (one over the error in ranks) of its quantile.
FALSE_REJECTIONS, QUANTILE_PRECISION = 0.001, 100_000
#: Temperatures of the score, of which the calibration takes the best.
TEMPERATURES = [2.0**p for p in range(-2, 8)]


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of every code point: 0 no letter, 1 to 26 a to z, other letters by a hash."""
    table = np.zeros(0x110000, np.uint8)
    points = np.array([c for c in range(0x110000) if chr(c).isalpha()], np.int64)
    table[points] = 27 + (points * 2654435761 >> 7) % (CLASSES - 27)
    table[ord("a") : ord("z") + 1] = np.arange(1, 27)
    return table


def grams_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Packed grams of all texts, and how many of them each text has.

    A text is its letters in lower case, words apart by one class-0 character, which also
    stands before and after it.
    """
    parts, sizes, letters = [], [], _classes()
    for text in texts:
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = letters[points]
        inside = kinds > 0
        keep = inside.copy()
        keep[1:] |= inside[:-1]  # one gap after each word
        own = kinds[keep]
        if not inside.any():
            sizes.append(0)
            continue
        padded = np.concatenate([np.zeros(ORDER - 1, np.uint8), own, np.zeros(1, np.uint8)]).astype(np.int32)
        grams = padded[: len(padded) - ORDER + 1].copy()
        for place in range(1, ORDER):
            grams <<= BITS
            grams |= padded[place : len(padded) - ORDER + 1 + place]
        parts.append(grams)
        sizes.append(len(grams))
    return (np.concatenate(parts) if parts else np.empty(0, np.int32)), np.array(sizes, np.int64)


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``BLOCK`` characters together."""
    first = held = 0
    for place, text in enumerate(texts):
        if held and held + len(text) > BLOCK:
            yield first, place
            first, held = place, 0
        held += len(text)
    if first < len(texts):
        yield first, len(texts)


@dataclass
class Model:
    """Log probabilities in sorted arrays, one pair for each order; a column per language.

    ``keys[k]`` are the grams of k + 1 characters seen in any language, sorted. A gram that
    was never seen takes the value of its shorter end, less the back-off of its context.
    """

    languages: list[str]
    keys: list[np.ndarray]
    values: list[np.ndarray]
    backoff: list[np.ndarray]
    #: Of a character that no language has.
    unseen: np.ndarray
    temperature: float = 1.0
    reject_above: np.ndarray | None = None

    def score(self, grams: np.ndarray) -> np.ndarray:
        """Natural log probability of each gram's last character, grams by languages."""
        out = np.empty((len(grams), len(self.languages)), np.float32)
        place, hit = _search(self.keys[-1], grams)
        out[hit] = self.values[-1][place[hit]]
        rest = np.flatnonzero(~hit)
        if len(rest):
            out[rest] = self._shorter(grams[rest], ORDER - 1)
        return out

    def _shorter(self, grams: np.ndarray, size: int) -> np.ndarray:
        """The last ``size`` characters' value plus the context's back-off."""
        mask = (1 << (BITS * size)) - 1
        context, short = grams >> BITS, grams & mask
        out = np.zeros((len(grams), len(self.languages)), np.float32)
        place, hit = _search(self.keys[size - 1], context & mask)
        out[hit] = self.backoff[size - 1][place[hit]]
        place, hit = _search(self.keys[size - 1], short)
        out[hit] += self.values[size - 1][place[hit]]
        rest = np.flatnonzero(~hit)
        if len(rest):
            out[rest] += self._shorter(short[rest], size - 1) if size > 1 else self.unseen
        return out


def _search(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return place, keys[place] == wanted


def kneser_ney(grams: np.ndarray, counts: np.ndarray) -> tuple[list, list, list]:
    """Interpolated Kneser-Ney of one language: keys, log values and log back-offs by order.

    The longest grams use their counts, shorter ones the number of different characters seen
    before them. Each order gives up a discount estimated from its grams seen once and twice.
    """
    keys, weights = [None] * ORDER, [None] * ORDER
    keys[-1], weights[-1] = grams.astype(np.int32), counts.astype(np.float64)
    for size in range(ORDER - 1, 0, -1):
        short, kinds = np.unique(keys[size] & ((1 << (BITS * size)) - 1), return_counts=True)
        keys[size - 1], weights[size - 1] = short.astype(np.int32), kinds.astype(np.float64)
    logs, backoffs, lower = [], [], None
    for size in range(1, ORDER + 1):
        own, weight = keys[size - 1], weights[size - 1]
        once, twice = (weight == 1).sum(), (weight == 2).sum()
        discount = once / (once + 2 * twice) if once else 0.5
        context, group, kinds = np.unique(own >> BITS, return_inverse=True, return_counts=True)
        total = np.bincount(group, weight)
        free = discount * kinds / total
        if size == 1:
            below = np.full(len(own), 1 / CLASSES)
        else:
            place = np.searchsorted(keys[size - 2], own & ((1 << (BITS * (size - 1))) - 1))
            below = lower[place]
        value = np.maximum(weight - discount, 0) / total[group] + free[group] * below
        lower = value
        logs.append(np.log(value))
        backoffs.append((context.astype(np.int32), np.log(free)))
    return keys, logs, backoffs


def _merged(models: dict[str, tuple]) -> Model:
    """One table for each order with a column per language.

    Where a language has not seen a gram that another has, its column gets the value that
    backing off gives, so a search finds all languages at once.
    """
    languages = sorted(models)
    keys, values, backoff = [], [], []
    floor = np.log(1 / CLASSES)
    for size in range(1, ORDER + 1):
        # Contexts of the next order belong to this order's table, for their back-offs.
        pool = [models[x][0][size - 1] for x in languages]
        if size < ORDER:
            pool += [models[x][2][size][0] for x in languages]
        own = np.unique(np.concatenate(pool)) if pool else np.empty(0, np.int32)
        table = np.empty((len(own), len(languages)), np.float32)
        after = np.zeros((len(own), len(languages)), np.float32)
        for column, name in enumerate(languages):
            seen, logs, backoffs = models[name]
            if size == 1:
                base = np.full(len(own), floor)
                contexts, free = backoffs[0]
                base = base + (free[0] if len(free) else 0)
            else:
                mask = (1 << (BITS * (size - 1))) - 1
                place, hit = _search(keys[size - 2], own & mask)
                base = np.where(hit, values[size - 2][place, column], floor) if len(keys[size - 2]) else np.full(len(own), floor)
                contexts, free = backoffs[size - 1]
                place, hit = _search(contexts, own >> BITS)
                base = base + np.where(hit, free[place], 0) if len(free) else base
            place, hit = _search(seen[size - 1], own)
            table[:, column] = np.where(hit, logs[size - 1][place], base) if len(logs[size - 1]) else base
            if size < ORDER:
                contexts, free = backoffs[size]
                place, hit = _search(contexts, own)
                after[:, column] = np.where(hit, free[place], 0) if len(free) else 0
        keys.append(own)
        values.append(table)
        backoff.append(after)
    unseen = [floor + models[x][2][0][1].sum() for x in languages]
    return Model(languages, keys, values, backoff, np.array(unseen, np.float32))


_COUNTS = pa.schema([("lang", pa.string()), ("gram", pa.int32()), ("n", pa.int64())])


def gram_counts(rows: DataFrame) -> DataFrame:
    """``lang, gram, n`` over the whole texts of all rows with ``lang`` and ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for rows in batches:
            by: dict[str, list[str]] = {}
            for lang, text in zip(rows["lang"].to_pylist(), rows["text"].to_pylist(), strict=True):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                for first, end in _blocks(texts):
                    grams, n = np.unique(grams_of(texts[first:end])[0], return_counts=True)
                    if lang in held:
                        both = np.concatenate([held[lang][0], grams])
                        grams, place = np.unique(both, return_inverse=True)
                        n = np.bincount(place, np.concatenate([held[lang][1], n])).astype(np.int64)
                    held[lang] = (grams, n)
        for lang, (grams, n) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.int32()), pa.array(n, pa.int64())],
                schema=_COUNTS,
            )

    counted = arrow_map(rows.select("lang", "text"), run, "lang string, gram int, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def entropies(rows: DataFrame, model: Model) -> DataFrame:
    """``rows``' columns (``id``, ``text`` among them) without text, plus ``n_grams`` and
    ``entropy``, an array with the nats per character under each language."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    passed = [f for f in rows.schema.fields if f.name != "text"]
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in passed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for rows in batches:
            texts, sizes, means = rows["text"].to_pylist(), [], []
            for first, end in _blocks(texts):
                grams, n = grams_of(texts[first:end])
                sums = np.zeros((len(n), len(own.languages)))
                filled = np.flatnonzero(n)
                if len(filled) and own.languages:
                    starts = np.concatenate([[0], np.cumsum(n[filled])[:-1]])
                    sums[filled] = np.add.reduceat(own.score(grams), starts, axis=0, dtype=np.float64)
                sizes += n.tolist()
                means += (-sums / np.maximum(n, 1)[:, None]).tolist()
            arrays = [rows[f.name] for f in passed]
            arrays += [pa.array(sizes, pa.int64()), pa.array(means, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*[f.name for f in passed], "n_grams", "entropy"])

    return arrow_map(rows, run, f"{ddl}, n_grams long, entropy array<double>")


def _calibrated(model: Model, scored: DataFrame) -> Model:
    """Fit the score's temperature and each language's rejection limit on all of ``scored``.

    ``scored`` has the ``lang``, ``n_grams`` and ``entropy`` of labelled texts. One aggregate by
    language: means of each temperature's loss, a quantile sketch and a deviation come back.
    """
    model.reject_above = np.full(len(model.languages), np.inf)
    if not model.languages:
        return model
    place = F.array_position(F.array(*[F.lit(x) for x in model.languages]), F.col("lang")).cast("int")
    rows = scored.withColumn("place", place).filter("place > 0 and n_grams > 0")
    rows = rows.select("place", "entropy", F.element_at("entropy", F.col("place")).alias("own"))
    least = F.array_min("entropy")

    def loss(temperature: float) -> Column:
        total = F.aggregate("entropy", F.lit(0.0), lambda acc, e: acc + F.exp((least - e) * temperature))
        return F.log(total) + (F.col("own") - least) * temperature

    found = rows.groupBy("place").agg(
        F.count("*").alias("n"),
        F.percentile_approx("own", 1 - FALSE_REJECTIONS, QUANTILE_PRECISION).alias("most"),
        F.stddev_pop("own").alias("spread"),
        F.array(*[F.sum(loss(t)) for t in TEMPERATURES]).alias("losses"),
    )
    found = sorted(found.collect(), key=lambda row: row["place"])
    if found:
        model.temperature = TEMPERATURES[int(np.argmin(np.sum([row["losses"] for row in found], axis=0)))]
    for row in found:
        # Above what its own texts reach, with room for texts shorter than these.
        model.reject_above[row["place"] - 1] = row["most"] + row["spread"]
    return model


def counted(rows: DataFrame) -> Model:
    """Models of all languages of ``rows`` (``text``, ``lang``, none of them null), not calibrated.

    Every row is counted. What reaches the driver is the table of distinct grams, whose size
    the classes bound (2**24 a language).
    """
    frame = gram_counts(rows).toPandas()
    models = {}
    for lang, own in frame.groupby("lang"):
        own = own.sort_values("gram")
        models[lang] = kneser_ney(own["gram"].to_numpy(), own["n"].to_numpy())
    return _merged(models)


def fit(rows: DataFrame) -> Model:
    """Models of all languages of ``rows`` (``id``, ``text``, ``lang``, none of the last two null).

    Every row is counted, and every row calibrates the score and the rejection.
    """
    model = counted(rows)
    return _calibrated(model, entropies(rows, model))


def predict(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` without text, plus ``lang_pred``, ``lang_or_und``, ``score``, ``cross_entropy``.

    ``lang_pred`` is the language of the lowest cross-entropy per character (the first by name
    on a tie), ``score`` its softmax at the calibrated temperature. ``lang_or_und`` is the same
    unless the cross-entropy is above the language's limit; then, and without letters,
    it is ``und``. A text without letters has ``und`` in both and score 0.
    """
    return _decided(entropies(rows, model), model)


def _decided(scored: DataFrame, model: Model) -> DataFrame:
    """``predict`` for rows that have their ``n_grams`` and ``entropy``."""
    names = F.array(*[F.lit(x) for x in model.languages]) if model.languages else None
    if names is None:
        return scored.drop("n_grams", "entropy").withColumns(
            {
                "lang_pred": F.lit("und"),
                "lang_or_und": F.lit("und"),
                "score": F.lit(0.0),
                "cross_entropy": F.lit(None).cast("double"),
            }
        )
    lettered = F.col("n_grams") > 0
    least = F.array_min("entropy")
    best = F.array_position("entropy", least).cast("int")
    spread = F.aggregate(
        "entropy", F.lit(0.0), lambda acc, e: acc + F.exp((least - e) * model.temperature)
    )
    limit: Column = F.element_at(F.array(*[F.lit(float(x)) for x in model.reject_above]), best)
    return scored.select(
        *[F.col(c) for c in scored.columns if c not in ("n_grams", "entropy")],
        F.when(lettered, F.element_at(names, best)).otherwise("und").alias("lang_pred"),
        F.when(lettered & (least <= limit), F.element_at(names, best)).otherwise("und").alias("lang_or_und"),
        F.when(lettered, 1 / spread).otherwise(0.0).alias("score"),
        F.when(lettered, least).alias("cross_entropy"),
    )


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", folds: int = 5) -> DataFrame:
    """``key, held_out, lang_pred, lang_or_und, score, cross_entropy`` for every row.

    Rows whose CRC-32 of the key as text leaves 0 modulo ``folds`` are held out; the others
    with a language and a text train the models and calibrate them, all of them. Language and key never enter a prediction.
    Null and letterless texts are ``und``; without any labelled row all are. A null key is
    not held out and trains. Repeated rows count as often as they are there.
    """
    rows = docs.select(
        col(key).cast("long").alias("id"),
        F.coalesce(col(text).cast("string"), F.lit("")).alias("text"),
        col(lang).cast("string").alias("lang"),
    )
    rest = F.coalesce(F.crc32(F.col("id").cast("string")) % folds, F.lit(1))
    rows = rows.withColumn("held_out", rest == 0)
    labelled = "not held_out and lang is not null"
    model = counted(rows.filter(f"{labelled} and text != ''"))
    # Written once, as the calibration and the prediction read the same entropies.
    scored = stage(entropies(rows, model), "entropies")
    model = _calibrated(model, scored.filter(labelled))
    found = _decided(scored.drop("lang"), model)
    return found.withColumnRenamed("id", key)
