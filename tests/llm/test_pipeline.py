"""The corpus pipeline, each stage next to a plain version of what it decides."""

import hashlib
import math
import re
from itertools import combinations

import pytest

import corpus_pipeline
from tabml.llm import decontaminate, quality
from tabml.sources.staging import stage

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Every stage's input and output rows."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, function in corpus_pipeline.STAGES:
        after = stage(function(spark, docs, SF), f"test-{name}")
        out[name] = (docs, after)
        docs = after
    return out


def rows(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def test_all_but_the_last_keep_the_columns(stages):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert [name for name, _ in corpus_pipeline.STAGES] == list(stages)
    assert all(stages[name][1].columns == columns for name in list(stages)[:-1])


def test_quality_keeps_what_the_scorer_accepts(spark, stages):
    docs, after = stages["quality"]
    _, scorer = quality.fit(docs)
    features, kept = quality.Features(), set()
    for row in docs.collect():
        words = (row["text"] or "").split()
        if words and scorer(*features(words, quality.statistics(words, row["text"]))) >= corpus_pipeline.LEAST_QUALITY:
            kept.add(row["doc_id"])
    assert set(rows(after)) == kept
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [k for k, v in labels.items() if v == 1]
    assert sum(k in kept for k in good) >= 0.95 * len(good)


def plain(line):
    return " ".join(re.sub(r"[\x00-/:-@\[-`{-\xbf]+", " ", line.lower()).split(" ")).strip()


def test_lines_are_the_first_of_equal_ones(stages):
    docs, after = stages["line_dedup"]
    before, kept = rows(docs), rows(after)
    left = [plain(line) for r in kept.values() for line in r["text"].split("\n") if len(plain(line).split(" ")) >= 3]
    assert len(left) == len(set(left))
    # Every line that is left was there, in order, and its first occurrence is not lost unless a similar line stays.
    for key, row in kept.items():
        at = iter(before[key]["text"].split("\n"))
        assert all(line in at for line in row["text"].split("\n")) and row["n_chars"] == len(row["text"])
    unlike = {plain(line) for r in before.values() for line in r["text"].split("\n")} - set(left)
    assert sum(len(line.split(" ")) >= 3 for line in unlike) < 0.1 * len(left)


def shingles(text):
    words = text.translate({c: c + 32 for c in range(65, 91)}).split()
    size = min(5, len(words))
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if words else set()


def test_one_of_each_near_duplicate_group_stays(stages):
    docs, after = stages["near_duplicates"]
    sets = {k: shingles(r["text"]) for k, r in rows(docs).items()}
    least = {k: k for k in sets}

    def root(k):
        return k if least[k] == k else root(least[k])

    for a, b in combinations(sorted(sets), 2):
        both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if either and 100 * both >= 75 * either:
            least[max(root(a), root(b))] = min(root(a), root(b))
    assert set(rows(after)) == {root(k) for k in sets}


def test_decontamination_takes_whole_items_out(spark, stages):
    docs, after = stages["decontamination"]
    benchmark = [decontaminate.words_of(r["text"] or "") for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept, gone = rows(after), set(rows(docs)) - set(rows(after))
    for key, row in rows(docs).items():
        text = " " + " ".join(decontaminate.words_of(row["text"])) + " "
        holds = any(item and f" {' '.join(item)} " in text for item in benchmark)
        assert not (holds and key in kept)
        if key in gone:
            # Most of some item's words come in order within some stretch of the text.
            words = decontaminate.words_of(row["text"])
            assert any(
                decontaminate.in_order(item, words[k : k + len(item) + 64]) >= decontaminate.ORDERED * len(item)
                for item in benchmark if item for k in range(0, len(words), 8)
            )


def test_mixing_draws_poisson_numbers(stages):
    docs, after = stages["mixing"]
    before = rows(docs)
    chars: dict = {}
    for r in before.values():
        chars[r["source"]] = chars.get(r["source"], 0) + len(r["text"])
    total, sources = sum(chars.values()), sum(n > 0 for n in chars.values())
    want = {}
    for key, r in before.items():
        mean = total / sources / chars[r["source"]] if chars[r["source"]] else 0.0
        pieces = max(1, math.ceil(mean / 16))
        number = 0
        for piece in range(1, pieces + 1):
            mark = hashlib.md5(f"17|{key}|{hashlib.md5(r['text'].encode()).hexdigest()}|{piece}".encode()).hexdigest()
            uniform = (int(mark[:13], 16) + 0.5) / 2**52
            term = below = math.exp(-mean / pieces)
            j = 0
            while below < uniform and j < 79:
                j += 1
                number += 1
                term *= mean / pieces / j
                below += term
            number += below < uniform
        if number and mean:
            want[key] = number
    got: dict = {}
    for r in after.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == want


def test_a_table_without_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SF), f"empty-{name}")
    assert docs.count() == 0 and docs.columns[-1] == "copy"
