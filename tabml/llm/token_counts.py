"""Exact token counts of every prefix of a text, by dynamic programming over prefixes."""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from operator import sub

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm.common import arrow_map, col

#: Pairs of tokens, and code points of texts and of pieces, whose answers a worker remembers.
REMEMBERED, REMEMBERED_LETTERS = 500_000, 4_000_000
#: Pieces solved in one numpy block, and bytes of it; pieces of more bytes are solved one by one.
SOLVED_TOGETHER, SOLVED_BYTES, LONG = 20_000, 400_000, 400
#: Of the rolling hash that finds tokens in a piece.
BASE, MASK = 0x9E3779B97F4A7C15, 2**64 - 1

# Fixed values of the vocabulary's file format: Unicode white space, the pieces a text is cut
# into, and the visible letters that stand for bytes.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
PIECES = regex.compile("|".join(CONTRACTIONS) + rf"|\p{{L}}+|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+")
SPACE = re.compile(f"[{WHITE}]")
CLUSTER = regex.compile(r"\X")
END = "</w>"


def _byte_letters() -> list[str]:
    """The letter of each byte: printable Latin-1 ones stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, free = {b: chr(b) for b in own}, 256
    for b in range(256):
        if b not in letters:
            letters[b], free = chr(free), free + 1
    return [letters[b] for b in range(256)]


class PrefixCounter:
    """Token counts of all prefixes under a byte-pair vocabulary with word ends.

    The last token of a prefix's encoding is the one vocabulary entry that ends there and may
    follow the last token of what comes before it. So ``count(prefix) = count(what comes
    before) + 1``: one step for each position, and no part is encoded twice. Pieces that are
    not remembered are solved together, position by position, in numpy.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        self.pairs = [tuple(p.split(" ") if isinstance(p, str) else p) for p in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(self.pairs)}
        self.made = {left + right: rank for (left, right), rank in self.ranks.items()}
        self.never = len(self.pairs)
        self.trees: dict[str, tuple] = {}
        self.follows: dict[int, bool] = {}
        self.chunks: dict[str, bytes] = {}
        self.solved: dict[str, list[int]] = {}
        #: Code points of both.
        self.chunk_letters = self.solved_letters = 0
        special = [t["content"] for t in data["added_tokens"] if t["special"]]
        self.special = regex.compile("|".join(map(regex.escape, special)) or r"(?!)")

        # Tokens by the hash of their bytes, those that end a word apart from the others.
        value = {letter: byte for byte, letter in enumerate(_byte_letters())}
        self.tokens = [""] * (max(model["vocab"].values()) + 1)
        keys: tuple[dict, dict] = ({}, {})
        self.bodies: tuple[dict[bytes, int], dict[bytes, int]] = ({}, {})
        self.longest = 1
        for token, number in model["vocab"].items():
            self.tokens[number] = token
            body = token[: -len(END)] if token.endswith(END) and token != END else token
            if token in special or any(letter not in value for letter in body):
                continue
            coded = 0
            for letter in body:
                coded = (coded * BASE + value[letter] + 1) & MASK
            keys[body != token][coded] = number
            self.bodies[body != token][bytes(value[letter] for letter in body)] = number
            self.longest = max(self.longest, len(body))
        self.tables = []
        for known in keys:
            hashes = np.array(sorted(known), np.uint64)
            self.tables.append((hashes, np.array([known[int(h)] for h in hashes], np.int64)))

    def _tree(self, token: str) -> tuple[list[tuple[str, int]], list[tuple[str, int]]]:
        """The symbols at the left and at the right edge of a token while it was merged.

        Each comes with the rank of the merge that uses it up (for the token itself: none).
        """
        found = self.trees.get(token)
        if found is None:
            found = ([(token, self.never)], [(token, self.never)])
            rank = self.made.get(token)
            if rank is not None:
                left, right = self.pairs[rank]
                for edge, part, side in ((0, left, found[0]), (1, right, found[1])):
                    own = self._tree(part)[edge]
                    side += [(own[0][0], rank), *own[1:]]
            self.trees[token] = found
        return found

    def may_follow(self, before: str, token: str) -> bool:
        """Whether ``token`` can stand after ``before``.

        It can unless two symbols that meet at the border would merge before either is used
        up inside its own token. Ranks grow along an edge, and of equal ranks the left merges
        first, which decides the two comparisons.
        """
        ranks, never = self.ranks, self.never
        starts = self._tree(token)[0]
        for left, left_used in self._tree(before)[1]:
            for right, right_used in starts:
                rank = ranks.get((left, right), never)
                if rank < left_used and rank <= right_used and rank != never:
                    return False
        return True

    def _allowed(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """``may_follow`` for token numbers; -1 before: the start of a piece."""
        pairs = before * 2**32 + token
        distinct, place = np.unique(pairs, return_inverse=True)
        known, names, answers = self.follows, self.tokens, []
        for pair in distinct.tolist():
            found = known.get(pair)
            if found is None:
                first, second = pair >> 32, pair & 0xFFFFFFFF
                found = first < 0 or self.may_follow(names[first], names[second])
                known[pair] = found
            answers.append(found)
        return np.array(answers, bool)[place]

    def _find(self, ends_word: int, hashes: np.ndarray) -> np.ndarray:
        keys, numbers = self.tables[ends_word]
        place = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return np.where(keys[place] == hashes, numbers[place], -1)

    def solve(self, pieces: list[str]) -> None:
        """Remember the token counts of the prefixes of pieces, after each character."""
        if len(self.follows) > 2 * REMEMBERED:
            self.follows.clear()
        coded = sorted(((p.encode("utf-8", "surrogatepass"), p) for p in pieces), key=lambda x: -len(x[0]))
        first = 0
        while first < len(coded):
            # A block is as wide as its first piece, so long pieces are few.
            rows = max(1, min(SOLVED_TOGETHER, SOLVED_BYTES // (len(coded[first][0]) + 1)))
            block = coded[first : first + rows]
            counts = self._solve([data for data, _ in block])
            for (data, piece), row in zip(block, counts, strict=True):
                self.solved[piece] = _by_character(data, len(piece), row[: len(data)].tolist())
                self.solved_letters += len(piece)
            first += rows

    def _solve_long(self, piece: str) -> list[int]:
        """The counts for one long piece, place by place: a few bytes of memory for each."""
        data = piece.encode("utf-8", "surrogatepass")
        size = len(data)
        last, inner, final = array("q", [-1]) * (size + 1), array("i", [0]) * (size + 1), array("i", [0]) * size
        inside, ending = self.bodies
        follows, names = self.follows, self.tokens
        for end in range(1, size + 1):
            if len(follows) > 2 * REMEMBERED:
                follows.clear()
            least = max(0, end - self.longest)
            for table in (inside, ending):
                for start in range(end - 1, least - 1, -1):
                    token = table.get(data[start:end])
                    if token is None:
                        continue
                    before = last[start]
                    if before >= 0:
                        pair = before * 2**32 + token
                        fits = follows.get(pair)
                        if fits is None:
                            fits = follows[pair] = self.may_follow(names[before], names[token])
                        if not fits:
                            continue
                    if table is inside:
                        last[end], inner[end] = token, inner[start] + 1
                    else:
                        final[end - 1] = inner[start] + 1
                    break
        return _by_character(data, len(piece), final.tolist())

    def _solve(self, block: list[bytes]) -> np.ndarray:
        """Counts after each byte; ``block`` has the longest first."""
        width, sizes = len(block[0]), np.array([len(data) for data in block])
        letters = np.frombuffer(b"".join(d.ljust(width, b"\0") for d in block), np.uint8)
        letters = letters.reshape(len(block), width).T
        hashes = np.zeros((width + 1, len(block)), np.uint64)
        powers = np.array([pow(BASE, n, 2**64) for n in range(width + 1)], np.uint64)
        for place in range(width):
            hashes[place + 1] = hashes[place] * np.uint64(BASE) + letters[place] + np.uint64(1)
        last = np.full((width + 1, len(block)), -1, np.int64)
        inner = np.zeros((width + 1, len(block)), np.int32)
        final = np.zeros((width, len(block)), np.int32)
        for end in range(1, width + 1):
            active = int(np.searchsorted(-sizes, -end, side="right"))
            for ends_word in (0, 1):
                open_rows = np.arange(active)
                for start in range(end - 1, max(0, end - self.longest) - 1, -1):
                    span = hashes[end, open_rows] - hashes[start, open_rows] * powers[end - start]
                    token = self._find(ends_word, span)
                    hit = np.flatnonzero(token >= 0)
                    if not len(hit):
                        continue
                    rows, token = open_rows[hit], token[hit]
                    fits = self._allowed(last[start, rows], token)
                    rows, token = rows[fits], token[fits]
                    if ends_word:
                        final[end - 1, rows] = inner[start, rows] + 1
                    else:
                        last[end, rows], inner[end, rows] = token, inner[start, rows] + 1
                    open_rows = np.delete(open_rows, hit[fits])
                    if not len(open_rows):
                        break
        return final.T

    def _counts(self, piece: str) -> list[int]:
        """Counts for a piece, also for contractions: cut short, they are other pieces."""
        if len(piece) > LONG:
            return self._solve_long(piece)
        if piece not in self.solved:
            self.solve([piece])
        if piece not in CONTRACTIONS:
            return self.solved[piece]
        cut = [PIECES.findall(piece[:size]) for size in range(1, len(piece))]
        return [sum(self._counts(p)[-1] for p in parts) for parts in cut] + self.solved[piece][-1:]

    def _plain(self, text: str) -> list[int]:
        """Counts of the prefixes of a normalised text without white space."""
        counts, base = [], 0
        for piece in PIECES.findall(text):
            counts += [base + n for n in self._counts(piece)]
            base = counts[-1]
        return counts

    def _normalised(self, text: str) -> list[int]:
        """Counts for each code point of ``text``, which holds no white space or special."""
        lower = lowered(text)
        if lower is not None:
            return self._plain(lower)
        # Only a decomposed character has to stay whole: it is composed before it is cut.
        clusters = []
        for cluster in CLUSTER.findall(text):
            whole = unicodedata.normalize("NFC", cluster) != cluster
            clusters += [cluster] if whole else cluster
        parts = ["".join(map(str.lower, unicodedata.normalize("NFC", c))) for c in clusters]
        counts, out, place = self._plain("".join(parts)), [], 0
        for cluster, part in zip(clusters, parts, strict=True):
            before = counts[place - 1] if place else 0
            place += len(part)
            out += [before] * (len(cluster) - 1) + [counts[place - 1] if place else 0]
        return out

    def _chunk(self, text: str) -> bytes:
        """Differences of the counts of successive prefixes of a text without white space."""
        counts: list[int] = []
        start = base = 0
        for match in self.special.finditer(text):
            # Cut short, a special string is ordinary text; whole, it is one token.
            counts += [base + n for n in self._normalised(text[start : match.end() - 1])]
            base = (counts[match.start() - 1] if match.start() else 0) + 1
            counts.append(base)
            start = match.end()
        if start < len(text):
            counts += [base + n for n in self._normalised(text[start:])]
        return array("h", map(sub, counts, [0, *counts])).tobytes()

    def _learn(self, chunks: set[str]) -> None:
        pieces = set()
        for chunk in chunks:
            lower = lowered(chunk)
            if lower is not None:
                pieces.update(p for p in PIECES.findall(lower) if len(p) <= LONG)
        if self.solved_letters > REMEMBERED_LETTERS:
            self.solved.clear()
            self.solved_letters = 0
        self.solve(list(pieces.difference(self.solved)))
        for chunk in chunks:
            self.chunks[chunk] = self._chunk(chunk)
            self.chunk_letters += len(chunk)

    def deltas(self, texts: list[str]) -> list[bytes]:
        """For each code point, by how much the token count changes (16 bits, little endian)."""
        split = [SPACE.split(text) for text in texts]
        if self.chunk_letters > REMEMBERED_LETTERS:
            self.chunks.clear()
            self.chunk_letters = 0
        self._learn(set().union(*split).difference(self.chunks))
        # A white space changes nothing, and what follows it starts afresh.
        return [b"\0\0".join(map(self.chunks.__getitem__, chunks)) for chunks in split]


def _by_character(data: bytes, size: int, counts: list[int]) -> list[int]:
    """Counts after each byte of ``size`` characters: those after each character's last one."""
    if len(data) == size:
        return counts
    # A character ends before the next one's first byte.
    return [n for n, byte in zip(counts, [*data[1:], 0], strict=True) if byte & 0xC0 != 0x80]


def lowered(text: str) -> str | None:
    """The normalised text if that has the same code points one by one, else None."""
    if text.isascii():
        return text.lower()
    if not unicodedata.is_normalized("NFC", text):
        return None
    lower = text.lower() if "\u03a3" not in text else "".join(map(str.lower, text))
    return lower if len(lower) == len(text) else None


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    """One counter for each worker process."""
    return PrefixCounter(path)


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Where this machine has the vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def counts_of(deltas: bytes) -> np.ndarray:
    """The token count of every prefix: entry i is that of the first i + 1 code points."""
    return np.cumsum(np.frombuffer(deltas, "<i2"), dtype=np.int64)


def prefix_counts(
    docs: DataFrame,
    vocab: str = "word_bpe_49k.json",
    limits: Sequence[int] = (2048,),
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """``key, n_bytes, n_tokens, prefix_deltas`` and ``fits_<limit>`` for every row.

    ``prefix_deltas`` holds, for each code point, the change of the exact token count when the
    prefix grows by it, as 16-bit integers; their running sum is the count of every prefix as
    the tokenizer itself gives it, without begin and end tokens. ``fits_<limit>`` is the
    length in code points of the longest prefix of at most that many tokens. ``tokens_at``
    and ``truncated`` answer from the stored column; no text is encoded again.

    A prefix that ends inside a decomposed character repeats the count before that character.
    Null text counts as empty: no bytes, no tokens. Null and repeated keys are kept as they
    are, extra columns are ignored, an empty table gives no rows. Time and memory grow with a
    text's length only. ``vocab`` is a file name of the tokenizer folder, which every machine
    has; the file is read once per worker process.
    """
    fields = [("id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())]
    fields += [(f"fits_{limit}", pa.int64()) for limit in limits]
    schema = pa.schema([*fields, ("prefix_deltas", pa.binary())])
    ddl = "id long, n_bytes long, n_tokens long, "
    ddl += "".join(f"fits_{limit} long, " for limit in limits) + "prefix_deltas binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(vocabulary(vocab))
        for rows in batches:
            sizes = pc.binary_length(rows["text"].cast(pa.binary())).cast(pa.int64())
            deltas = counts.deltas(rows["text"].to_pylist())
            totals, fits = [], [[] for _ in limits]
            for own in deltas:
                running = counts_of(own)
                totals.append(int(running[-1]) if len(running) else 0)
                for place, limit in enumerate(limits):
                    inside = np.flatnonzero(running <= limit)
                    fits[place].append(int(inside[-1]) + 1 if len(inside) else 0)
            arrays = [rows["id"], sizes, pa.array(totals, pa.int64())]
            arrays += [pa.array(column, pa.int64()) for column in fits]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(deltas, pa.binary())], schema=schema)

    rows = docs.select(
        col(key).cast("long").alias("id"), F.coalesce(col(text).cast("string"), F.lit("")).alias("text")
    )
    return arrow_map(rows, run, ddl).withColumnRenamed("id", key)


def tokens_at(counted: DataFrame, position: str, into: str = "tokens_at") -> DataFrame:
    """The token count of the first ``position`` code points (a column; beyond the end: all)."""

    @F.pandas_udf("long")
    def at(deltas, place):  # noqa: ANN001
        return deltas.combine(place, lambda d, p: int(np.frombuffer(d, "<i2")[: max(0, p)].sum(dtype=np.int64)))

    return counted.withColumn(into, at(col("prefix_deltas"), col(position)))


def truncated(counted: DataFrame, budget: str, into: str = "fits") -> DataFrame:
    """The longest prefix, in code points, of at most ``budget`` tokens (a column)."""

    @F.pandas_udf("long")
    def fits(deltas, most):  # noqa: ANN001
        def longest(own: bytes, limit: int) -> int:
            inside = np.flatnonzero(counts_of(own) <= limit)
            return int(inside[-1]) + 1 if len(inside) else 0

        return deltas.combine(most, longest)

    return counted.withColumn(into, fits(col("prefix_deltas"), col(budget)))
