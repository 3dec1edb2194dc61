"""Decontamination next to a search of every passage."""

import random
import re

import numpy as np
import pytest

from tabml.llm import decontaminate


def texts(draw, vocabulary, number, size):
    return [" ".join(draw.choice(vocabulary) for _ in range(size)) + "." for _ in range(number)]


@pytest.fixture(scope="module")
def planted(spark):
    """Items whole and paraphrased in longer texts of the same words, and texts without any."""
    draw = random.Random(4)
    vocabulary = ["".join(draw.choice("abcdefghij") for _ in range(5)) for _ in range(900)]
    items = [t for size in (9, 20, 33) for t in texts(draw, vocabulary, 12, size)]
    docs, want = [], set()
    for number, item in enumerate(items):
        for share in (1.0, 0.8):
            words = [w if draw.random() < share else draw.choice(vocabulary) for w in item.split()]
            words = item.split() if share == 1.0 else words
            around = texts(draw, vocabulary, 2, draw.randint(1, 150))
            docs.append((len(docs), " ".join([around[0], *words, around[1]])))
            want.add((len(docs) - 1, number, share))
    docs += [(len(docs) + k, t) for k, t in enumerate(texts(draw, vocabulary, 40, 200))]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(
        list(enumerate(items)), "item_id long, text string"
    )
    return docs, items, want, *frames


def brute(docs, items):
    """Pairs by the longest common subsequence alone, over every passage."""
    step, found = decontaminate.STEP, set()
    for item in decontaminate._items([{"item": k, "text": t} for k, t in enumerate(items)]):
        n = len(item.words)
        for doc, text in docs:
            words = decontaminate.words_of(text)
            for at in range(-(-len(words) // step)):
                passage = words[max(0, (at - 1) * step) : (at + 3 + -(-n // step)) * step]
                # The plain table of lengths.
                table = np.zeros((n + 1, len(passage) + 1), int)
                for i, a in enumerate(item.words):
                    for j, b in enumerate(passage):
                        table[i + 1, j + 1] = table[i, j] + 1 if a == b else max(table[i, j + 1], table[i + 1, j])
                share = table[n, -1] / n
                if share >= decontaminate.ORDERED:
                    found.add((doc, item.number, round(share, 6)))
    best = {}
    for doc, number, share in found:
        best[doc, number] = max(share, best.get((doc, number), 0))
    return best


def rows(frame):
    return {(r["doc_id"], r["item_id"]): r["ordered"] for r in frame.collect()}


def test_every_passage_is_the_plain_search(planted):
    docs, items, _, documents, benchmark = planted
    few = [d for d in docs if len(d[1].split()) < 120][:24]
    got = rows(decontaminate.leaks(documents.filter(documents.doc_id.isin([d[0] for d in few])), benchmark, least_cosine=-1.0))
    want = brute(few, items)
    # One sentence: its answer is the whole item, so a share of ORDERED is enough.
    assert {k: round(v, 6) for k, v in got.items()} == want and want


def test_candidates_by_cosine_find_nearly_all(planted):
    _, _, want, documents, benchmark = planted
    exact, got = rows(decontaminate.leaks(documents, benchmark, least_cosine=-1.0)), rows(decontaminate.leaks(documents, benchmark))
    assert set(got) <= set(exact)
    assert len(got) >= 0.95 * len(exact), (len(got), len(exact))
    whole = {(doc, item) for doc, item, share in want if share == 1.0}
    assert whole <= set(got)
    changed = {(doc, item) for doc, item, share in want if share < 1.0}
    assert len(changed & set(got)) >= 0.9 * len(changed), len(changed & set(got))
    assert all((doc, item, 1.0) in want or (doc, item, 0.8) in want for doc, item in got)


def test_word_bound_counts_distinct_words():
    draw = np.random.default_rng(3)
    words = [f"w{k}" for k in range(60)]
    known = {w: decontaminate._term(w) for w in words}
    active = np.zeros(decontaminate.TERMS, bool)
    active[list(known.values())] = True
    columns = np.cumsum(active) - 1
    width = int(active.sum())
    vectors = np.vstack([draw.random((width, 5)), np.zeros(5)]).astype(np.float32)
    space = decontaminate.Space(vectors, np.append(np.where(active, columns, width), width).astype(np.int32))
    items = [decontaminate.Item(k, [words[j] for j in draw.integers(0, 60, n)], 0) for k, n in enumerate((3, 10, 17, 30, 40))]
    searcher = decontaminate.Searcher(items, known, space, -1.0)
    pieces = [draw.integers(0, width + 1, n).astype(np.int32) for n in (1, 16, 200, 77)]
    got = {(p, s, i) for p, s, i, _ in searcher.candidates(pieces)}
    want = set()
    for p, piece in enumerate(pieces):
        for s in range(-(-len(piece) // decontaminate.STEP)):
            for i, item in enumerate(items):
                size = -(-len(item.words) // decontaminate.STEP) + 1
                around = set(piece[max(0, (s - 1) * 16) : (s + size + 2) * 16].tolist()) - {width}
                own = {int(r) for r in searcher._rows(item.words)}
                distinct = [int(r) for r in searcher._rows(sorted(set(item.words)))]
                if sum(r in around for r in distinct) >= len(distinct) - 0.4 * len(item.words) - 1e-6 and own:
                    want.add((p, s, i))
    assert got == want and len(want) > 20


def test_words_are_the_pattern_s():
    draw = np.random.default_rng(11)
    texts = ["", "Straße Été_1", "İ Ÿ", "a b\x85c\x1cd", "\ud800 x", "".join(map(chr, range(256)))]
    for top in (128, 256, 0x400):
        texts += ["".join(map(chr, draw.integers(0, top, 300))) for _ in range(50)]
    for text in texts:
        assert decontaminate.words_of(text) == re.findall(r"\w+", text.lower()), text
    # All texts of one byte a character go by the table, without the pattern.
    assert decontaminate._WORD_BYTES.decode("latin-1").split() == re.findall(r"\w+", "".join(map(chr, range(256))))


@pytest.fixture(scope="module")
def many(spark):
    """More texts than a fitted sample would have, words of the benchmark in all and in the last ones only."""
    draw = random.Random(9)
    vocabulary = [f"word{k}" for k in range(150)]
    common = vocabulary[:90]
    docs = [" ".join(draw.choice([*common, "other"]) for _ in range(draw.randint(0, 150))) for _ in range(2600)]
    docs += [" ".join(draw.choice(vocabulary[90:]) for _ in range(100)) for _ in range(40)] + [""]
    items = decontaminate._items([{"item": k, "text": t} for k, t in enumerate(texts(draw, vocabulary, 25, 30))])
    known = {w: decontaminate._term(w) for i in items for w in i.words}
    frame = spark.createDataFrame(list(enumerate(docs)), "id long, text string").repartition(5)
    return docs, items, known, decontaminate.fit_passages(frame, known)


def test_frequencies_and_passages_are_of_all_texts(many):
    docs, _, known, passages = many
    frequency, n = decontaminate.document_frequencies(passages)
    assert n == len(docs)
    for word, term in known.items():
        alike = {w for w, t in known.items() if t == term}
        assert frequency[term] == sum(not alike.isdisjoint(decontaminate.words_of(text)) for text in docs), word
    sizes = [k for row in passages.collect() for k in row["sizes"]]
    words = [decontaminate.words_of(text) for text in docs]
    want = [sum(w in known for w in own[k : k + 64]) for own in words for k in range(0, len(own), 64)]
    assert sorted(sizes) == sorted(k for k in want if k)


@pytest.mark.parametrize("paired", [4096, 0])
def test_latent_space_is_that_of_all_passages(many, monkeypatch, paired):
    docs, items, known, passages = many
    monkeypatch.setattr(decontaminate, "PAIRED_TERMS", paired)
    monkeypatch.setattr(decontaminate, "RANK", 60)
    frequency, n = decontaminate.document_frequencies(passages)
    space = decontaminate.latent_space(passages, items, known, frequency, n)
    idf = np.log((1 + n) / (1 + frequency))
    plain = []
    for words in [decontaminate.words_of(text) for text in docs] + [item.words for item in items]:
        for k in range(0, len(words), decontaminate.FIT_WORDS):
            row = np.zeros(len(space.vectors))
            for word in words[k : k + decontaminate.FIT_WORDS]:
                if word in known:
                    row[space.rows[known[word]]] += idf[known[word]]
            if row.any():
                plain.append(row / np.linalg.norm(row))
    square = np.array(plain).T @ np.array(plain)
    weights = np.zeros(len(space.vectors))
    for term in known.values():
        weights[space.rows[term]] = idf[term]
    basis = np.divide(space.vectors, weights[:, None], out=np.zeros_like(space.vectors, dtype=float), where=weights[:, None] > 0)
    kept = weights > 0
    assert np.allclose(basis[kept].T @ basis[kept], np.eye(60), atol=1e-3)
    best = np.sort(np.linalg.eigvalsh(square))[::-1][:60].sum()
    # The spectrum of random words is flat, which one turn does not sort out wholly.
    assert np.trace(basis.T @ square @ basis) >= 0.98 * best


def test_products_of_passages_are_the_plain_ones():
    draw = np.random.default_rng(2)
    sizes = np.array([1, 5, 64, 5, 1, 30], np.uint8)
    terms = draw.integers(0, 40, int(sizes.sum())).astype(np.uint16)
    columns, idf = draw.permutation(40), draw.random(40).astype(np.float32)
    idf[columns[terms[0]]] = 0
    total = np.zeros((40, 40))
    decontaminate._add_products(total, terms, sizes, idf, columns)
    want = np.zeros((40, 40))
    for own in np.split(terms, np.cumsum(sizes.astype(int))[:-1]):
        row = np.bincount(columns[own], minlength=40) * idf
        if row.any():
            row = row / np.linalg.norm(row)
        want += np.outer(row, row)
    assert np.allclose(total, np.triu(want), atol=1e-6)
