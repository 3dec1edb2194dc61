"""Personal data: fixed patterns, and a linear-chain CRF over word shapes that adds spans."""

from __future__ import annotations

import bisect
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.llm import pii_table
from tabml.llm.common import arrow_map, col

KINDS = ("email", "ip", "card", "phone")
#: Characters decoded in one numpy batch; words whose features a worker remembers.
BLOCK, REMEMBERED = 300_000, 300_000

# Labels: outside, the first word of each kind, any further word of a span.
OUTSIDE, INSIDE = 0, len(KINDS) + 1
LABELS = len(KINDS) + 2
CELLS, FEATURES = 2**12, 6

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
# A number's first digit starts the match: from a later one there would be none either.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_WORD = re.compile(r"\S+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    """Whether the check digit fits."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _ip_fits(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in text.split("."))


def _card_fits(text: str) -> bool:
    digits = "".join(_DIGITS.findall(text)) if len(text) < 60 else ""
    return 13 <= len(digits) <= 19 and luhn(digits)


def _phone_fits(text: str) -> bool:
    return 9 <= len(_DIGITS.findall(text)) <= 15


_FITS = {"ip": _ip_fits, "card": _card_fits, "phone": _phone_fits}


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from each @ so that long words cost one look each."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield ("email", start, domain.end())
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, by kind, then start."""
    spans = list(_emails(text)) if "@" in text else []
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        if kind == "phone" and "+" not in text:
            continue
        fits = _FITS[kind]
        spans += [(kind, *m.span()) for m in pattern.finditer(text) if fits(m[0])]
    return spans


def joined(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


def shape(word: str) -> str:
    """Letters as x or X, runs as one; each digit as 9, more than twenty in a run as twenty;
    marks as they are, more than three alike as three."""
    out: list[str] = []
    run, kept = 0, ""
    for character in word:
        if "0" <= character <= "9":
            kind, most = "9", 20
        elif character.isalpha():
            kind, most = ("X" if character.isupper() else "x"), 1
        else:
            kind, most = character, 3
        run = run + 1 if kind == kept else 1
        kept = kind
        if run <= most:
            out.append(kind)
    return "".join(out)


# Words that tell what a number next to them is.
CUES = frozenset(
    "tel telefon telephone phone fax call mobile mobil cell handy dial card visa karte isbn issn order invoice iban "
    "tracking ref serial id version date pp key at dot".split()
)
_BRACKETED = re.compile(r"[\[({](?:at|dot|\.)[\])}]", re.IGNORECASE)


def _cue(word: str) -> str:
    if _BRACKETED.search(word):
        return "(at)" if _BRACKETED.fullmatch(word) is None else word[1:-1].lower()
    bare = word.strip(".:,;()").lower() if len(word) < 16 else ""
    return bare if bare in CUES else ""


def _cells(word: str) -> list[int]:
    """The hashed features of a word: its shape, the shape without runs, digits, marks, edges,
    and the word itself if it is one of ``CUES``."""
    own = shape(word)
    short = re.sub(r"(.)\1+", r"\1", own)
    digits = own.count("9")
    marks = "".join(sorted(set(own) - {"x", "X", "9"}))
    names = (f"s{own}", f"r{short}", f"d{min(digits, 20)}", f"m{marks}", f"e{own[:1]}{own[-1:]}", f"w{_cue(word)}")
    return [zlib.crc32(name.encode("utf-8", "surrogatepass")) % CELLS for name in names]


def word_labels(line: str, spans: list[Span]) -> list[int]:
    """A label for each word of a line, from spans with offsets in it."""
    places = [m.span() for m in _WORD.finditer(line)]
    labels = [OUTSIDE] * len(places)
    for kind, start, end in spans:
        inside = [k for k, (a, b) in enumerate(places) if a < end and start < b]
        for number, place in enumerate(inside):
            labels[place] = INSIDE if number else 1 + KINDS.index(kind)
    return labels


@dataclass
class ChainModel:
    """Weights of a linear-chain CRF: a word's own features and those of its neighbours."""

    own: np.ndarray  # cells, labels
    before: np.ndarray
    after: np.ndarray
    steps: np.ndarray  # label, next label
    first: np.ndarray

    @classmethod
    def empty(cls) -> ChainModel:
        zero = [np.zeros((CELLS, LABELS)) for _ in range(3)]
        return cls(*zero, np.zeros((LABELS, LABELS)), np.zeros(LABELS))


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(values - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(lines: list[tuple[list[str], list[int]]], rounds: int = 30, rate: float = 0.25) -> ChainModel:
    """Maximum likelihood by forward-backward and AdaGrad over blocks of labelled lines."""
    model = ChainModel.empty()
    lines = sorted((x for x in lines if x[0]), key=lambda x: len(x[0]))
    if not any(label for _, labels in lines for label in labels):
        model.first[OUTSIDE] = 1.0
        model.steps[:, OUTSIDE] = 1.0
        return model
    blocks = []
    for first in range(0, len(lines), 64):
        block = lines[first : first + 64]
        width = max(len(words) for words, _ in block)
        cells = np.full((len(block), width + 2, FEATURES), -1)
        truth = np.zeros((len(block), width), int)
        sizes = np.array([len(words) for words, _ in block])
        for row, (words, labels) in enumerate(block):
            cells[row, 1 : len(words) + 1] = [_cells(w) for w in words]
            truth[row, : len(words)] = labels
        blocks.append((cells, truth, sizes))
    tables = (model.own, model.before, model.after, model.steps, model.first)
    squares = [np.full_like(t, 1e-6) for t in tables]
    for _ in range(rounds):
        for cells, truth, sizes in blocks:
            grads = _gradient(model, cells, truth, sizes)
            for table, square, grad in zip(tables, squares, grads, strict=True):
                grad -= 1e-3 * table
                square += grad**2
                table += rate * grad / np.sqrt(square)
    return model


def _gradient(model: ChainModel, cells: np.ndarray, truth: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Of the log likelihood of one block."""
    rows, width = truth.shape
    views = (cells[:, 1:-1], cells[:, :-2], cells[:, 2:])
    emit = np.zeros((rows, width, LABELS))
    for table, view in zip((model.own, model.before, model.after), views, strict=True):
        emit += np.where(view[..., None] >= 0, table[view], 0).sum(axis=2)
    live = np.arange(width)[None, :] < sizes[:, None]
    forward, backward = np.zeros((rows, width, LABELS)), np.zeros((rows, width, LABELS))
    forward[:, 0] = model.first + emit[:, 0]
    for t in range(1, width):
        forward[:, t] = _log_sum(forward[:, t - 1, :, None] + model.steps, 1) + emit[:, t]
    for t in range(width - 2, -1, -1):
        on = _log_sum(model.steps + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        backward[:, t] = np.where((t + 1 < sizes)[:, None], on, 0)
    total = _log_sum(forward[np.arange(rows), sizes - 1], 1)
    marginal = np.exp(forward + backward - total[:, None, None]) * live[..., None]
    error = (np.eye(LABELS)[truth] - marginal) * live[..., None]
    grads = [np.zeros((CELLS, LABELS)) for _ in range(3)]
    for grad, view in zip(grads, views, strict=True):
        seen = view >= 0
        np.add.at(grad, view[seen], np.broadcast_to(error[:, :, None, :], (*view.shape, LABELS))[seen])
    steps = np.zeros((LABELS, LABELS))
    for t in range(1, width):
        rows_on = np.flatnonzero(t < sizes)
        if not len(rows_on):
            break
        joint = forward[rows_on, t - 1, :, None] + model.steps + (emit[rows_on, t] + backward[rows_on, t])[:, None, :]
        steps -= np.exp(joint - total[rows_on, None, None]).sum(axis=0)
        np.add.at(steps, (truth[rows_on, t - 1], truth[rows_on, t]), 1)
    return [*grads, steps, error[:, 0].sum(axis=0)]


class Tagger:
    """Viterbi decoding of many lines at once."""

    def __init__(self, model: ChainModel):
        self.model = model
        self.places: dict[str, int] = {}
        self.shapes: dict[tuple, int] = {}
        self._reset()

    def _reset(self) -> None:
        self.places.clear()
        self.shapes.clear()
        # Row 0 stands for the place before and after a line.
        self.rows = np.zeros((1024, 3, LABELS), np.float32)
        self.used = 1

    def _learn(self, words: set[str]) -> None:
        model = self.model
        for word in words:
            cells = tuple(_cells(word))
            place = self.shapes.get(cells)
            if place is None:
                if self.used == len(self.rows):
                    self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
                place = self.shapes[cells] = self.used
                at = list(cells)
                self.rows[place] = model.own[at].sum(0), model.before[at].sum(0), model.after[at].sum(0)
                self.used += 1
            self.places[word] = place

    def decode(self, lines: list[list[str]]) -> list[np.ndarray]:
        """The best labels of each line's words; lines have words."""
        lines_by_size = sorted(range(len(lines)), key=lambda k: -len(lines[k]))
        missing = set().union(*lines).difference(self.places)
        if len(self.places) + len(missing) > REMEMBERED:
            self._reset()
            missing = set().union(*lines)
        self._learn(missing)
        sizes = np.array([len(lines[k]) for k in lines_by_size])
        find = self.places.__getitem__
        flat = np.fromiter((p for k in lines_by_size for p in (0, *map(find, lines[k]), 0)), np.int32, int(sizes.sum()) + 2 * len(sizes))
        emit = self.rows[:, 0][flat]
        emit[1:] += self.rows[:, 1][flat[:-1]]
        emit[:-1] += self.rows[:, 2][flat[1:]]
        starts = np.concatenate([[0], np.cumsum(sizes + 2)[:-1]]) + 1
        steps = self.model.steps.astype(np.float32)
        back = np.zeros((len(flat), LABELS), np.int8)
        score = emit[starts] + self.model.first.astype(np.float32)
        final = np.zeros((len(sizes), LABELS), np.float32)
        active = len(sizes)
        for t in range(1, int(sizes[0])):
            now = int(np.searchsorted(-sizes, -t, side="left"))
            final[now:active] = score[now:active]
            active = now
            options = score[:active, :, None] + steps
            best = options.argmax(axis=1)
            back[starts[:active] + t] = best
            score = np.take_along_axis(options, best[:, None, :], 1)[:, 0] + emit[starts[:active] + t]
        final[:active] = score[:active]
        labels = np.zeros(len(flat), np.int8)
        own = final.argmax(axis=1)
        for t in range(int(sizes[0]) - 1, -1, -1):
            active = int(np.searchsorted(-sizes, -(t + 1), side="right"))
            at = starts[:active] + t
            labels[at] = own[:active]
            own[:active] = back[at, own[:active]] if t else own[:active]
        out: list[np.ndarray] = [None] * len(lines)  # type: ignore[list-item]
        for k, start, size in zip(lines_by_size, starts, sizes, strict=True):
            out[k] = labels[start : start + size]
        return out


# The forms that an added span of each kind must have.
_DOT = r"(?:\.|\x20?[\[({](?:dot|\.)[\])}]\x20?)"
_FORMS = {
    "email": re.compile(
        r"[^\s@]+@[^\s@]*\.[^\s@]*[A-Za-z0-9]"
        r"|[A-Za-z0-9._%+-]+\x20?[\[({]at[\])}]\x20?[A-Za-z0-9-]+(?:" + _DOT + r"[A-Za-z0-9-]+)+",
        re.IGNORECASE,
    ),
    "ip": re.compile(r"[0-9]{1,3}(?:" + _DOT + r"[0-9]{1,3}){3}", re.IGNORECASE),
    "card": re.compile(r"[0-9][0-9 .-]*[0-9]"),
    "phone": re.compile(r"[+(]?[0-9][ ().0-9/-]*[0-9]"),
}
# What every added span holds outside the spans of the fixed patterns: an @ in a word, an at or
# dot in brackets, or a run of digits and separators, of nine digits or four parts.
_SEED = re.compile(r"[^\s@]@[^\s@]|[\[({](?:at|dot|\.)[\])}]|[0-9][ ().0-9/-]*[0-9]", re.IGNORECASE)
_LEAD, _TAIL = re.compile(r"[^A-Za-z0-9+(]+"), re.compile(r"[^A-Za-z0-9]+\Z")


def _numbers(text: str) -> str:
    return ".".join(re.findall("[0-9]+", text))


def _added(line: str, offset: int, labels: np.ndarray, taken: _Taken) -> Iterator[Span]:
    """The spans that a line's labels say, as far as they can be what they are called and do
    not touch a span of the fixed patterns."""
    places = [m.span() for m in _WORD.finditer(line)]
    k = 0
    while k < len(places):
        if not 0 < labels[k] < INSIDE:
            k += 1
            continue
        kind, first = KINDS[labels[k] - 1], k
        k += 1
        while k < len(places) and labels[k] == INSIDE:
            k += 1
        start, end = places[first][0], places[k - 1][1]
        lead = _LEAD.match(line, start, end)
        start = lead.end() if lead else start
        if line.startswith("(", start) and (kind != "phone" or ")" not in line[start:end].rstrip(").,;")):
            start += 1
        text = _TAIL.sub("", line[start:end])
        fits = _FORMS[kind].fullmatch(text) is not None
        if fits and kind != "email":
            fits = _FITS[kind](_numbers(text) if kind == "ip" else text)
        start, end = offset + start, offset + start + len(text)
        if fits and not taken.meets(start, end):
            yield (kind, start, end)


class _Taken:
    """The places of a text that the fixed patterns' spans cover."""

    def __init__(self, base: list[Span]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, start, end in sorted(base, key=lambda s: s[1:]):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(end, self.ends[-1])
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meets(self, start: int, end: int) -> bool:
        last = bisect.bisect_left(self.starts, end) - 1
        return last >= 0 and self.ends[last] > start

    def mask(self, text: str) -> str:
        """``text`` with line ends in these places."""
        pieces, done = [], 0
        for start, end in zip(self.starts, self.ends, strict=True):
            pieces += [text[done:start], "\n" * (end - start)]
            done = end
        return "".join([*pieces, text[done:]]) if pieces else text


def open_lines(text: str, taken: _Taken) -> Iterator[tuple[int, str]]:
    """Offset and text of every line that can hold an added span; no other line can."""
    masked = taken.mask(text)
    done = 0
    for seed in _SEED.finditer(masked):
        if seed.start() < done:
            continue
        found = seed[0]
        if found[0].isdigit() and found[-1].isdigit() and "@" not in found:
            if len(_DIGITS.findall(found)) < 9 and found.count(".") < 3:
                continue
        start = text.rfind("\n", 0, seed.start()) + 1
        done = text.find("\n", seed.end())
        done = done if done >= 0 else len(text)
        yield start, text[start:done]


def all_spans(texts: list[str], tagger: Tagger, every_line: bool = False) -> list[tuple[list[Span], list[Span]]]:
    """For each text the fixed patterns' spans and those that the tagger adds.

    Lines that cannot hold an added span are not decoded; ``every_line`` decodes them as well,
    which gives the same spans.
    """
    base = [base_spans(text) for text in texts]
    taken = [_Taken(spans) for spans in base]
    added: list[list[Span]] = [[] for _ in texts]
    held: list[tuple[int, int, str, list[str]]] = []
    size = 0

    def flush() -> None:
        found = tagger.decode([words for *_, words in held]) if held else []
        for (number, offset, line, _), labels in zip(held, found, strict=True):
            if labels.any():
                added[number] += _added(line, offset, labels, taken[number])
        held.clear()

    for number, text in enumerate(texts):
        lines = _lines(text) if every_line else open_lines(text, taken[number])
        for offset, line in lines:
            words = line.split()
            if words:
                held.append((number, offset, line, words))
                size += len(line)
                if size > BLOCK:
                    flush()
                    size = 0
    flush()
    return list(zip(base, added, strict=True))


def _lines(text: str) -> Iterator[tuple[int, str]]:
    offset = 0
    for line in text.split("\n"):
        yield offset, line
        offset += len(line) + 1


def labelled_lines() -> list[tuple[list[str], list[int]]]:
    """Words and labels of the lines of the labelled table."""
    return [(line.split(), word_labels(line, spans)) for line, spans in pii_table.marked_lines()]


_FOUND = pa.schema(
    [(f"n_{kind}", pa.int64()) for kind in KINDS]
    + [("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())]
)


def find(
    docs: DataFrame,
    labelled: list[tuple[list[str], list[int]]] | None = None,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """``key, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added`` for every row.

    The counts and the digest are of the fixed patterns; ``spans`` has all spans as
    ``kind:start:end``, by kind, start and end, in code points with exclusive ends. The CRF
    learns from ``labelled`` (words and labels of lines; by default the table in ``pii_table``)
    and adds what the patterns do not read: phone numbers without +, cards with other
    separators, addresses spelled with an at in brackets or a domain of other letters. Its
    spans are added where they have a form of their kind and touch none of the others. It
    decodes, whole, every line that can hold such a span.

    Null text counts as empty: no spans. Null and repeated keys stay as they are, equal texts
    get equal spans, extra columns are ignored, an empty table gives no rows. Of two paths of
    equal score the one with the smaller label is taken. Work grows with a text's length; no
    line or word is cut.
    """
    model = train(labelled_lines() if labelled is None else labelled)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value)
        for rows in batches:
            found = all_spans(rows["text"].to_pylist(), tagger)
            kinds = [[sum(s[0] == kind for s in base) for base, _ in found] for kind in KINDS]
            arrays = [rows["id"], *[pa.array(n, pa.int64()) for n in kinds]]
            arrays.append(pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found]))
            arrays.append(pa.array([joined(base + added) for base, added in found], pa.string()))
            arrays.append(pa.array([len(added) for _, added in found], pa.int64()))
            yield pa.RecordBatch.from_arrays(arrays, names=["id", *_FOUND.names])

    rows = docs.select(
        col(key).cast("long").alias("id"), F.coalesce(col(text).cast("string"), F.lit("")).alias("text")
    )
    ddl = ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in _FOUND)
    return arrow_map(rows, run, f"id long, {ddl}").withColumnRenamed("id", key)
