"""Benchmark passages in documents: latent semantic retrieval, then word-by-word checks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import arrow_map, col
from tabml.sources.staging import stage

#: Hashed terms, latent dimensions, and dimensions that the random projection has more.
TERMS, RANK, OVERSAMPLED = 2**15, 384, 16
#: Passages start at every ``STEP`` words; an item of n words looks at passages of n + STEP.
STEP = 16
#: Words of a passage that the latent space is fitted on. Up to so many terms of the benchmark, the
#: products of all pairs are summed in one pass; with more, a pass for each projection.
FIT_WORDS, PAIRED_TERMS = 64, 4096
#: Cosine of a candidate; shares of an item's words that must come in order in the passage.
COSINE, ORDERED, ORDERED_SURE, ANSWER = 0.4, 0.6, 0.8, 0.5
#: Bytes of benchmark text that are searched for in one pass over the documents.
BENCHMARK_BYTES = 16 * 1024 * 1024
#: Words searched at once, words of a text in one piece, items searched for at once.
BLOCK, PIECE, GROUP = 16_000, 8_000, 1_000
#: Pieces in which the tasks' sums are added up before they go to the driver.
SLICES = 16

_WORDS = re.compile(r"\w+")
#: Latin-1 with a space for every character that is in no word.
_WORD_BYTES = bytes(c if _WORDS.fullmatch(chr(c)) else 32 for c in range(256))


def words_of(text: str) -> list[str]:
    text = text.lower()
    try:
        narrow = text.encode("latin-1")
    except UnicodeEncodeError:
        return _WORDS.findall(text)
    return narrow.translate(_WORD_BYTES).decode("latin-1").split()


def _term(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) % TERMS


class Terms:
    """Terms of words; words that the benchmark has not are ``TERMS``."""

    def __init__(self, known: dict[str, int]):
        self.known = known

    def __call__(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.known.get, words, repeat(TERMS)), np.int32, len(words))


@dataclass
class Item:
    """A benchmark item: its words, and where its answer (the last sentence) begins."""

    number: int
    words: list[str]
    answer: int


def _items(rows: list) -> list[Item]:
    out = []
    for row in rows:
        text = row["text"] or ""
        sentences = [words_of(s) for s in re.split(r"[.!?\n]+", text)]
        sentences = [s for s in sentences if s]
        if sentences:
            words = [w for s in sentences for w in s]
            out.append(Item(row["item"], words, len(words) - len(sentences[-1])))
    return sorted(out, key=lambda item: (item.number is not None, item.number or 0, item.words))


def in_order(item: list[str], passage: list[str]) -> int:
    """Length of the longest common subsequence, one integer operation for each word.

    A zero bit says that the sequence is longer up to that place of the item.
    """
    places: dict[str, int] = {}
    for place, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << place
    full = (1 << len(item)) - 1
    state = full
    for word in passage:
        hit = state & places.get(word, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(item) - state.bit_count()


def matched_places(item: list[str], passage: list[str]) -> set[int]:
    """The item's places in one longest common subsequence, read back from ``in_order``'s states."""
    places: dict[str, int] = {}
    for place, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << place
    full = (1 << len(item)) - 1
    states = [full]
    for word in passage:
        hit = states[-1] & places.get(word, 0)
        states.append(((states[-1] + hit) | (states[-1] - hit)) & full)
    used, place, column = set(), len(item) - 1, len(passage)
    while place >= 0 and column:
        if states[column] >> place & 1:
            place -= 1
        elif states[column - 1] >> place & 1:
            # Longer by this place only since this word.
            used.add(place)
            place, column = place - 1, column - 1
        else:
            column -= 1
    return used


@dataclass
class Space:
    """Latent vectors of the benchmark's terms, weighted; the last one, of any other term, is zero.

    ``rows`` says which vector a term has.
    """

    vectors: np.ndarray
    rows: np.ndarray


def fit_passages(rows: DataFrame, known: dict[str, int]) -> DataFrame:
    """The benchmark's terms in all passages of all texts, staged: one row for each batch of texts.

    ``terms`` are those of the passages, one after another, as 16-bit numbers, ``sizes`` how many
    each passage has, passages without any left out. ``term, n`` say in how many texts of the
    batch each term is, ``texts`` how many texts there are.
    """
    shared = rows.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(shared.value)
        for rows in batches:
            found = [terms(words_of(text)) for text in rows["text"].to_pylist()]
            held, sizes = _packed(found)
            counts = np.zeros(TERMS + 1, np.int64)
            for own in found:
                own = np.sort(own)
                counts[own[np.flatnonzero(np.diff(own, prepend=-1))]] += 1
            used = np.flatnonzero(counts[:TERMS])
            columns = [
                pa.array([held.tobytes()]), pa.array([sizes.tobytes()]), pa.array([used.tolist()], pa.list_(pa.int32())),
                pa.array([counts[used].tolist()], pa.list_(pa.int64())), pa.array([len(found)], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["terms", "sizes", "term", "n", "texts"])

    ddl = "terms binary, sizes binary, term array<int>, n array<long>, texts long"
    staged = stage(arrow_map(rows.select("text"), run, ddl), "passages")
    shared.destroy()
    return staged


def _packed(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' terms, passage by passage, and the number of each passage that has any."""
    if not texts:
        return np.empty(0, np.uint16), np.empty(0, np.uint8)
    lengths = np.array([len(text) for text in texts])
    first = np.cumsum(lengths) - lengths
    passages = -(-lengths // FIT_WORDS)
    flat = np.concatenate(texts)
    within = (np.arange(len(flat)) - np.repeat(first, lengths)) // FIT_WORDS
    on = flat < TERMS
    sizes = np.bincount((within + np.repeat(np.cumsum(passages) - passages, lengths))[on])
    return flat[on].astype(np.uint16), sizes[sizes > 0].astype(np.uint8)


def document_frequencies(passages: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all texts each benchmark term occurs, and how many texts there are."""
    counted = passages.select(F.explode(F.arrays_zip("term", "n")).alias("one")).groupBy("one.term")
    out = np.zeros(TERMS, np.int64)
    for term, n in counted.agg(F.sum("one.n")).collect():
        out[term] = n
    return out, int(passages.agg(F.sum("texts")).first()[0] or 0)


def _matrix(passages: list[np.ndarray], idf: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """TF-IDF rows of passages over the benchmark's terms, of length one."""
    out = np.zeros((len(passages), int(columns.max()) + 1), np.float32)
    for row, terms in enumerate(passages):
        terms = terms[terms < TERMS]
        np.add.at(out[row], columns[terms], idf[terms])
    lengths = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, lengths, out=out, where=lengths > 0)


def _total(parts: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """Sum of the tasks' matrices, added up slice by slice on the executors."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for rows in batches:
            for number, data in zip(rows["slice"].to_pylist(), rows["part"].to_pylist(), strict=True):
                part = np.frombuffer(data, np.float32).astype(np.float64)
                sums[number] = sums[number] + part if number in sums else part
        yield pa.RecordBatch.from_arrays(
            [pa.array(sums, pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())],
            names=["slice", "part"],
        )

    found = arrow_map(parts.repartition(SLICES, "slice"), add, "slice int, part binary").collect()
    if not found:
        return np.zeros(shape)
    return np.concatenate([np.frombuffer(r["part"]) for r in sorted(found, key=lambda r: r["slice"])]).reshape(shape)


def _add_products(total: np.ndarray, terms: np.ndarray, sizes: np.ndarray, idf: np.ndarray, columns: np.ndarray) -> None:
    """Add the products of the entries of every passage's TF-IDF row, of length one, to the upper
    triangle ``total[column, column]``."""
    width = len(total)
    passage = np.repeat(np.arange(len(sizes)), sizes)
    cells = np.sort(passage * width + columns[terms])
    first = np.flatnonzero(np.diff(cells, prepend=-1))
    times = np.diff(np.append(first, len(cells)))
    passage, column = cells[first] // width, cells[first] % width
    value = times * idf[column]
    lengths = np.sqrt(np.bincount(passage, value * value, len(sizes)))
    value = np.divide(value, lengths[passage], out=np.zeros_like(value), where=lengths[passage] > 0)
    distinct = np.bincount(passage, minlength=len(sizes))
    begin = np.cumsum(distinct) - distinct
    flat = total.reshape(-1)
    for number in np.unique(distinct):
        left, right = np.triu_indices(number)
        alike, block = begin[distinct == number], max(1, 500_000 // max(1, len(left)))
        for at in range(0, len(alike), block):
            entry = alike[at : at + block, None] + np.arange(number)
            of, weight = column[entry], value[entry]
            place = of[:, left] * width + of[:, right]
            np.add.at(flat, place.reshape(-1), (weight[:, left] * weight[:, right]).reshape(-1))


def latent_space(passages: DataFrame, items: list[Item], known: dict[str, int], frequency: np.ndarray, n: int) -> Space:
    """Randomised SVD of the TF-IDF passages A of all texts and the benchmark's items.

    A random projection, one turn of it with ``A' A`` and its small core. Each task sums ``A' A``
    itself over its passages, or where the benchmark has more than ``PAIRED_TERMS`` terms its
    products with the projections, in three passes. The sums have a row for each benchmark term,
    ``TERMS`` at most.
    """
    spark = passages.sparkSession
    idf = np.log((1 + n) / (1 + frequency)).astype(np.float32)
    active = np.zeros(TERMS, bool)
    active[list(known.values())] = True
    used = np.flatnonzero(active)
    # Frequent terms side by side, as their sums are added to most.
    used = used[np.argsort(-frequency[used], kind="stable")]
    columns = np.zeros(TERMS, np.int64)
    columns[used] = np.arange(len(used))
    width = len(used)
    rank = min(RANK, width)
    packed = _packed([Terms(known)(item.words) for item in items])
    own = spark.createDataFrame([tuple(bytearray(part.tobytes()) for part in packed)], "terms binary, sizes binary")
    whole = passages.select("terms", "sizes").union(own)

    def products() -> np.ndarray:
        shared = spark.sparkContext.broadcast((idf[used], columns))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights, places = shared.value
            total = np.zeros((width, width))
            for rows in batches:
                for terms, sizes in zip(rows["terms"], rows["sizes"], strict=True):
                    _add_products(
                        total, np.frombuffer(terms.as_buffer(), np.uint16), np.frombuffer(sizes.as_buffer(), np.uint8), weights, places
                    )
            upper = np.concatenate([row[place:] for place, row in enumerate(total)]).astype(np.float32)
            parts = [part.tobytes() for part in np.array_split(upper, SLICES)]
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(parts)], names=["slice", "part"])

        upper = _total(arrow_map(whole, run, "slice int, part binary"), (width * (width + 1) // 2,))
        shared.destroy()
        out = np.zeros((width, width), np.float32)
        out[np.triu_indices(width)] = upper
        out += np.triu(out, 1).T
        return out

    def summed(basis: np.ndarray, second: bool) -> np.ndarray:
        shared = spark.sparkContext.broadcast((basis, idf, columns))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, weights, places = shared.value
            total = np.zeros((own.shape[1], own.shape[1]) if second else own.shape, np.float32)
            for rows in batches:
                for terms, sizes in zip(rows["terms"], rows["sizes"], strict=True):
                    ends = np.cumsum(np.frombuffer(sizes.as_buffer(), np.uint8), dtype=np.int64)
                    found = np.split(np.frombuffer(terms.as_buffer(), np.uint16), ends[:-1])
                    for first in range(0, len(ends), 500):
                        matrix = _matrix(found[first : first + 500], weights, places)
                        image = matrix @ own
                        total += image.T @ image if second else matrix.T @ image
            parts = [part.tobytes() for part in np.array_split(total.reshape(-1), SLICES)]
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(parts)], names=["slice", "part"])

        shape = (basis.shape[1], basis.shape[1]) if second else basis.shape
        out = _total(arrow_map(whole, run, "slice int, part binary"), shape)
        shared.destroy()
        return out

    if width <= PAIRED_TERMS:
        square = products()

        def summed(basis: np.ndarray, second: bool) -> np.ndarray:
            image = square @ basis
            return basis.T @ image if second else image

    size = min(width, rank + OVERSAMPLED)
    start = np.random.default_rng(7).standard_normal((width, size)).astype(np.float32)
    basis = np.linalg.qr(summed(start, second=False))[0].astype(np.float32)
    basis = np.linalg.qr(summed(basis, second=False))[0].astype(np.float32)
    core = summed(basis, second=True)
    turned = basis @ np.linalg.eigh(core)[1][:, ::-1][:, :rank]
    vectors = np.zeros((width + 1, rank), np.float32)
    vectors[:width] = turned * idf[used][:, None]
    return Space(vectors, np.append(np.where(active, columns, width), width).astype(np.int32))


_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("item_id", pa.int64()),
        ("start_word", pa.int64()),
        ("cosine", pa.float64()),
        ("ordered", pa.float64()),
        ("answer", pa.float64()),
    ]
)


@dataclass
class Group:
    """Items of about one length: the passages that they look at have ``size`` steps."""

    size: int
    items: np.ndarray
    vectors: np.ndarray
    #: Distinct words of each item, and how many of them a passage must have for the share that
    #: has to be in order.
    words: np.ndarray
    needed: np.ndarray
    #: Items by word: those of word w are ``having[first[w] : first[w + 1]]``.
    first: np.ndarray
    having: np.ndarray


class Searcher:
    """Finds items in texts; ``least_cosine=-1`` checks all passages whose words allow a match."""

    def __init__(self, items: list[Item], known: dict[str, int], space: Space, least_cosine: float = COSINE):
        self.items, self.terms, self.space, self.least_cosine = items, Terms(known), space, least_cosine
        self.groups = []
        for size in sorted({-(-len(i.words) // STEP) for i in items}):
            alike = [k for k, i in enumerate(items) if -(-len(i.words) // STEP) == size]
            self.groups += [self._group(size + 1, alike[k : k + GROUP]) for k in range(0, len(alike), GROUP)]
        self.longest = max(group.size for group in self.groups)
        #: Words of the benchmark that any passage with enough words of any item has at least.
        self.fewest = max(1, int(np.ceil(min(group.needed.min() for group in self.groups))))
        #: Words after a piece that a passage which starts in it needs.
        self.after = (self.longest + 2) * STEP

    def _group(self, size: int, own: list[int]) -> Group:
        nothing = len(self.space.vectors) - 1
        vectors = np.stack([self.space.vectors[self._rows(self.items[k].words)].sum(axis=0) for k in own])
        lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
        vectors = np.divide(vectors, lengths, out=np.zeros_like(vectors), where=lengths > 0)
        each = [self._rows(sorted(set(self.items[k].words))) for k in own]
        words = np.full((len(own), max(map(len, each))), nothing, np.int32)
        for place, found in enumerate(each):
            words[place, : len(found)] = found
        needed = [len(found) - (1 - ORDERED) * len(self.items[k].words) for found, k in zip(each, own, strict=True)]
        # Words of one term are one row, each of which may be in the passage.
        pairs = np.concatenate([np.stack([found, np.full(len(found), place)], axis=1) for place, found in enumerate(each)])
        pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
        first = np.searchsorted(pairs[:, 0], np.arange(nothing + 2))
        return Group(size, np.array(own), vectors, words, np.array(needed) - 1e-6, first, pairs[:, 1].astype(np.int64))

    def _rows(self, words: list[str]) -> np.ndarray:
        return self.space.rows[self.terms(words)]

    def possible(self, piece: np.ndarray) -> bool:
        """Whether any stretch as long as the longest item's surroundings has enough benchmark words.

        Shorter surroundings lie inside such a stretch, so what this rules out holds no item.
        """
        seen = np.concatenate([[0], np.cumsum(piece != len(self.space.vectors) - 1)])
        width = min(len(piece), (self.longest + 4) * STEP)
        return bool((seen[width:] - seen[: len(seen) - width]).max() >= self.fewest)

    def candidates(self, pieces: list[np.ndarray]) -> Iterator[tuple[int, int, int, float]]:
        """Piece, step at which a passage starts, item and cosine, for pieces of texts.

        The pieces lie in one row of steps with gaps, so that no passage runs into the next.
        Only where so many of an item's words are around a step that enough of them can be in
        order is the passage projected; with the cosine it is a candidate.
        """
        sizes = [-(-len(piece) // STEP) for piece in pieces]
        starts = np.cumsum([0, *[size + self.longest + 1 for size in sizes]])
        steps = int(starts[-1])
        nothing = len(self.space.vectors) - 1
        padded = np.full(steps * STEP, nothing, np.int32)
        owner = np.full(steps, -1, np.int32)
        for number, (piece, start, size) in enumerate(zip(pieces, starts, sizes, strict=False)):
            padded[start * STEP : start * STEP + len(piece)] = piece
            owner[start : start + size] = number
        # The distinct benchmark words of every step.
        own = np.flatnonzero(padded != nothing)
        cells = np.sort(own // STEP * (nothing + 1) + padded[own])
        cells = cells[np.flatnonzero(np.diff(cells, prepend=-1))]
        of_step, word = cells // (nothing + 1), cells % (nothing + 1)
        present = np.zeros((steps + self.longest + 4, nothing // 8 + 1), np.uint8)
        # Row k is step k - 1.
        np.bitwise_or.at(present, (of_step + 1, word >> 3), (1 << (word & 7)).astype(np.uint8))
        found = []
        for group in self.groups:
            at, column = self._with_words(group, of_step, word, steps)
            on = owner[at] >= 0
            found.append(self._distinct(group, present, at[on], column[on]))
        used = np.zeros(steps, bool)
        for group, (at, _) in zip(self.groups, found, strict=True):
            for further in range(group.size):
                used[at + further] = True
        places = np.cumsum(used) - 1
        sums = np.zeros((int(used.sum()), self.space.vectors.shape[1]), np.float32)
        wanted = np.flatnonzero(used)
        for begin in range(0, len(wanted), 512):
            rows = padded.reshape(steps, STEP)[wanted[begin : begin + 512]]
            sums[begin : begin + 512] = self.space.vectors[rows].sum(axis=1)
        for group, (at, column) in zip(self.groups, found, strict=True):
            for begin in range(0, len(at), 2048):
                some, items = at[begin : begin + 2048], column[begin : begin + 2048]
                passages = sums[places[some]]
                for further in range(1, group.size):
                    passages += sums[places[some + further]]
                lengths = np.sqrt(np.einsum("ij,ij->i", passages, passages))
                cosines = np.einsum("ij,ij->i", passages, group.vectors[items])
                cosines = np.divide(cosines, lengths, out=np.zeros_like(cosines), where=lengths > 0)
                keep = cosines >= self.least_cosine
                some, items, piece = some[keep], items[keep], owner[some[keep]]
                yield from zip(
                    piece.tolist(), (some - starts[piece]).tolist(), group.items[items].tolist(), cosines[keep].tolist(), strict=True
                )

    def _with_words(self, group: Group, of_step: np.ndarray, word: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
        """Steps and items of which so many words are in the steps around, those in several
        steps counted in each: no fewer than the distinct ones."""
        number = group.first[word + 1] - group.first[word]
        before = np.cumsum(number) - number
        entry = np.arange(int(number.sum())) + np.repeat(group.first[word] - before, number)
        items = len(group.items)
        cell = np.repeat(of_step, number) * items + group.having[entry]
        # A passage that starts at step k reads from k - 1 to k + size + 1.
        counts = np.zeros((steps + 4, items), np.int32)
        np.cumsum(np.bincount(cell, minlength=steps * items).reshape(steps, items), axis=0, out=counts[2 : steps + 2])
        counts[steps + 2 :] = counts[steps + 1]
        around = counts[group.size + 3 :] - counts[: steps + 1 - group.size]
        at = np.flatnonzero(around >= np.ceil(group.needed).astype(np.int32))
        return at // items, at % items

    def _distinct(self, group: Group, present: np.ndarray, at: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those steps and items that have as many distinct words."""
        nothing = len(self.space.vectors) - 1
        places, bits = (group.words >> 3).astype(np.intp), (1 << (group.words & 7)).astype(np.uint8)
        bits[group.words == nothing] = 0
        kept = [np.empty(0, bool)]
        around = present[: len(present) - group.size - 2].copy()
        for further in range(1, group.size + 3):
            around |= present[further : further + len(around)]
        row, flat = around.shape[1], around.reshape(-1)
        block = max(1, 250_000 // group.words.shape[1])
        for begin in range(0, len(at), block):
            some, wanted = at[begin : begin + block], column[begin : begin + block]
            seen = np.take(flat, (some * row)[:, None] + np.take(places, wanted, axis=0))
            seen &= np.take(bits, wanted, axis=0)
            kept.append(np.count_nonzero(seen, axis=1) >= group.needed[wanted])
        keep = np.concatenate(kept)
        return at[keep], column[keep]

    def check(self, number: int, words: list[str], step: int, cosine: float, least: float) -> tuple | None:
        """An item's row if the words around a candidate hold it, with a share of ``least`` at least."""
        item = self.items[number]
        n = len(item.words)
        # The passage and one step on both sides: a paraphrase may be longer than the item.
        first = max(0, (step - 1) * STEP)
        passage = words[first : (step + 3 + -(-n // STEP)) * STEP]
        share = in_order(item.words, passage) / n
        if share < max(ORDERED, least):
            return None
        used = matched_places(item.words, passage)
        answer = sum(place >= item.answer for place in used) / (n - item.answer)
        if share < ORDERED_SURE and answer < ANSWER:
            return None
        return (item.number, first, cosine, share, answer)

    def search(self, texts: list[str]) -> list[tuple]:
        """Number of the text, then the best passage of each item that it holds."""
        best: dict[tuple[int, int], tuple] = {}
        words: dict[int, list[str]] = {}
        held: list[tuple[int, int, np.ndarray]] = []
        size = 0

        def flush() -> None:
            for piece, step, item, cosine in self.candidates([rows for *_, rows in held]):
                number, offset, _ = held[piece]
                known = best.get((number, item))
                row = self.check(item, words[number], offset + step, cosine, known[3] if known else 0.0)
                if row and (known is None or (-known[3], known[1]) > (-row[3], row[1])):
                    best[number, item] = row
            held.clear()

        for number, text in enumerate(texts):
            words[number] = words_of(text)
            found = self._rows(words[number])
            for first in range(0, len(found), PIECE):
                if not self.possible(found[first : first + PIECE + self.after]):
                    continue
                held.append((number, first // STEP, found[first : first + PIECE + self.after]))
                size += len(held[-1][2]) + (self.longest + 1) * STEP
                if size > BLOCK:
                    flush()
                    words, size = {number: words[number]}, 0
        if held:
            flush()
        return [(number, *best[number, item]) for number, item in sorted(best)]


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[Item]]:
    """The benchmark's items, in blocks of at most about ``BENCHMARK_BYTES``."""
    rows = benchmark.select(col(item).cast("long").alias("item"), col(text).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    number = int(size // BENCHMARK_BYTES) + 1
    for block in range(number):
        own = rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(number)) == block).distinct()
        items = _items(own.collect())
        if items:
            yield items


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item: str = "item_id",
    item_text: str = "text",
    least_cosine: float = COSINE,
) -> DataFrame:
    """``doc_id, item_id, start_word, cosine, ordered, answer``: benchmark items in documents.

    A passage starts at every ``STEP`` words of every text, for each length of items. Those
    with too few words of an item to hold it are left out, which loses nothing; the others are
    projected to the latent space, and those with a cosine of ``least_cosine`` to the item are
    candidates (-1: all are, the exact way, for comparison). They count if the longest common subsequence has ``ORDERED`` of the item's words and ``ANSWER``
    of those in its last sentence, or ``ORDERED_SURE`` of all. One row for each document and
    item: its best passage, the first of equals.

    The benchmark is a stated set of queries; one larger than ``BENCHMARK_BYTES`` is searched
    for in several passes. Term frequencies and the latent space come from all documents. Null and empty texts on
    either side match nothing; repeated rows report each; null keys are passed on; an empty
    benchmark or table gives no rows; extra columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(
        col(key).cast("long").alias("id"), F.coalesce(col(text).cast("string"), F.lit("")).alias("text")
    )
    ddl = "doc_id long, item_id long, start_word long, cosine double, ordered double, answer double"
    out = None
    for items in _blocks(benchmark, item, item_text):
        known = {w: _term(w) for i in items for w in i.words}
        passages = fit_passages(rows, known)
        space = latent_space(passages, items, known, *document_frequencies(passages))
        shared = spark.sparkContext.broadcast((items, known, space, least_cosine))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            searcher = Searcher(*shared.value)
            for rows in batches:
                ids = rows["id"].to_pylist()
                found = [(ids[number], *row) for number, *row in searcher.search(rows["text"].to_pylist())]
                columns = list(zip(*found, strict=True)) if found else [[] for _ in _FOUND]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, _FOUND, strict=True)], schema=_FOUND
                )

        part = arrow_map(rows, run, ddl)
        out = part if out is None else out.union(part)
    return spark.createDataFrame([], ddl) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` without the rows that hold a benchmark item.

    A row goes if a row of its key and text has a leak; a null key is a key like others.
    Other columns, whatever their names, come back as they are; null texts hold nothing.
    """
    value = F.coalesce(col(text).cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(col(key).cast("string"), value).alias("mark"), value.alias("value"))
    found = leaks(rows.select("mark", "value"), benchmark, "value", "mark")
    marks = stage(found.select(F.col("doc_id").alias("mark")).distinct(), "leaks")
    return rows.join(marks, "mark", "left_anti").select("row.*")
