"""The operators next to brute-force versions, and on awkward rows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tabml.llm import (
    chat,
    content_sort,
    decontaminate,
    language,
    line_dedup,
    mixing,
    ngram_join,
    pii,
    quality,
    token_counts,
)
from tabml.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, node int, rate string"
AWKWARD = [
    (1, None, None, None, None, "x", 1, "y"),
    (2, "", "en", "a", 0, None, None, None),
    (None, "one two three four five six", "en", None, 5, "x", 1, "y"),
    (3, "same text of five words here", "en", "a", 5, "x", 1, "y"),
    (3, "same text of five words here", "en", "a", 5, "x", 1, "y"),
    (4, "same text of five words here", None, "b", 5, "x", 1, "y"),
    (5, "word " * 40_000, "en", "b", 5, "x", 1, "y"),
    (6, "\n\n \t\n", "de", "b", 5, "x", 1, "y"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_components(spark):
    links = spark.createDataFrame([(5, 4), (3, 4), (9, 8), (7, 7), (2, None)], "x long, y long")
    got = {r["node"]: r["label"] for r in components(links, "x", "y").collect()}
    assert got == {3: 3, 4: 3, 5: 3, 8: 8, 9: 8}


def test_base_spans_like_plain_patterns():
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    fits = {"email": lambda t: True, **pii._FITS}
    draw = random.Random(3)
    for _ in range(4000):
        text = "".join(draw.choice("ab.@1 2+-()%4\n5é") for _ in range(draw.randint(0, 40)))
        want = [
            (kind, *m.span()) for kind, p in kinds.items() for m in re.finditer(p, text) if fits[kind](m[0])
        ]
        assert pii.base_spans(text) == want, text


def test_viterbi_is_the_best_path():
    import itertools

    import numpy as np

    draw = np.random.default_rng(1)
    model = pii.ChainModel(*[draw.normal(size=(pii.CELLS, pii.LABELS)) for _ in range(3)], draw.normal(size=(6, 6)), draw.normal(size=6))
    lines = [["a1", "+b", "9-9"], ["x"], ["q@q.q", "7"]]
    got = pii.Tagger(model).decode(lines)

    def score(words, labels):
        cells = [pii._cells(w) for w in words]
        total = model.first[labels[0]]
        for k, label in enumerate(labels):
            total += model.own[cells[k], label].sum()
            total += model.before[cells[k - 1], label].sum() if k else 0
            total += model.after[cells[k + 1], label].sum() if k + 1 < len(words) else 0
            total += model.steps[labels[k - 1], label] if k else 0
        return total

    for words, labels in zip(lines, got, strict=True):
        best = max(itertools.product(range(6), repeat=len(words)), key=lambda p: score(words, p))
        assert tuple(labels) == best


def test_ngram_join_on_awkward_rows(awkward, empty):
    got = [tuple(r) for r in ngram_join.jaccard_components(awkward).collect()]
    by = {r[0]: r[1:] for r in got}
    assert len(got) == len(AWKWARD)
    assert by[1] == (0, 1) and by[2] == (0, 2) and by[3] == (2, 3) and by[4] == (2, 3) and by[5] == (1, 5)
    assert ngram_join.jaccard_components(empty).count() == 0


def test_bitmaps_never_rule_out_a_link():
    import numpy as np

    draw = np.random.default_rng(2)
    for size in (1, 5, 300, 2000):
        one = np.unique(draw.integers(0, 2**63, size).astype(np.uint64))
        two = np.unique(np.concatenate([one[size // 7 :], draw.integers(0, 2**63, size // 9).astype(np.uint64)]))
        differ = len(np.setxor1d(one, two))
        assert ngram_join.least_difference(ngram_join.bitmap(one), ngram_join.bitmap(two)) <= differ


def test_content_groups(awkward, empty):
    rows = content_sort.content_groups(awkward, keep="largest").collect()
    assert len(rows) == len(AWKWARD)
    group = [r for r in rows if r["group_size"] == 3]
    assert {r["keep_id"] for r in group} == {4} and sum(r["kept"] for r in group) == 1
    least = content_sort.content_groups(awkward).filter("group_size = 3").collect()
    assert {r["keep_id"] for r in least} == {3} and sum(r["kept"] for r in least) == 1
    assert content_sort.content_groups(empty).count() == 0


def test_mixing(spark, awkward, empty):
    docs = spark.createDataFrame(
        [(i, "x" * 10, "big" if i % 4 else "small") for i in range(8000)], "doc_id long, text string, source string"
    )
    got = {r["source"]: r["count"] for r in mixing.mix(docs, {"big": 1.0, "small": 1.0}).groupBy("source").count().collect()}
    assert abs(got["big"] - 4000) < 300 and abs(got["small"] - 4000) < 300
    rates = spark.createDataFrame([("a", 50.0), ("b", None)], "source string, rate double")
    many = mixing.replicate(awkward, rates)
    assert many.columns == awkward.columns
    assert {r["source"] for r in many.select("source").distinct().collect()} == {"a"}
    assert mixing.mix(empty).count() == 0


def test_prefix_counts_like_the_tokenizer(spark, awkward, empty):
    from tokenizers import Tokenizer

    path = token_counts.vocabulary()
    library, own = Tokenizer.from_file(path), token_counts.PrefixCounter(path)
    draw = random.Random(5)
    letters = "abcdeinorst'ABI.,!?0 \n\té字ßΣ😀"
    for _ in range(150):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(1, 14)))
        text = text[:4] + "<|endoftext|>" + text[4:] if draw.random() < 0.2 else text
        want = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(1, len(text) + 1)]
        assert token_counts.counts_of(own.deltas([text])[0]).tolist() == want, text
    counted = token_counts.prefix_counts(awkward, limits=(3,))
    assert counted.filter("fits_3 > 0 and n_tokens > 3").count() == 5
    asked = token_counts.tokens_at(counted.withColumn("at", F.lit(8)), "at").filter("doc_id = 4").first()
    assert asked["tokens_at"] == 2
    assert token_counts.prefix_counts(empty).count() == 0


def test_language(spark, sf_dir, awkward, empty):
    got = language.identify(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = got.filter("held_out").join(docs, "doc_id")
    assert held.filter("lang_pred = lang").count() >= 0.97 * held.count() > 0
    rows = language.identify(awkward).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 6)} == {"und"}
    assert language.identify(empty).count() == 0


def test_chat(spark):
    said = [("user", r"\### Assistant: </turn> ok\\"), ("a: b\\", "###</turn>"), ("assistant", "####</turn </turn>")]
    template = chat.Template()
    for role, text in said:
        written = "".join(t for t, _ in template.segments(role, text))
        assert template.read(written) == (role, text)
        assert written.count("</turn>") == 1
    rows = spark.createDataFrame(
        [(1, 0, "user", "q", 1), (1, 1, "assistant", None, 1), (1, 2, "assistant", "b", 1), (None, None, None, None, 1)],
        "conv_id long, turn long, role string, text string, state int",
    )
    got = chat.format_turns(rows).orderBy("conv_id", "turn").collect()
    assert [r["valid"] for r in got] == [False, True, True, False]
    back = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(rows)).collect()}
    assert back[1]["n_turns"] == 3 and back[1]["loss_chars"] == 1
    assert chat.read_back(chat.format_turns(rows.limit(0))).count() == 0


def test_quality(spark, awkward, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    _, scorer = quality.fit(docs)
    scored = docs.select("doc_id", quality.score_column(docs, scorer).alias("score"))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen = scored.join(labels, "doc_id")
    good, bad = seen.filter("quality = 1"), seen.filter("quality = 0")
    assert good.filter("score >= 0.5").count() >= 0.97 * good.count()
    assert bad.filter("score < 0.5").count() >= 0.7 * bad.count()
    for frame in (awkward, empty):
        _, own = quality.fit(frame)
        assert frame.select(quality.score_column(frame, own)).count() == frame.count()


def test_lines(spark, awkward, empty):
    docs = spark.createDataFrame(
        [(1, "The first line here.\nshort\nunique words in one"), (2, "the FIRST line, here\nshort\nother words of two"), (3, None)],
        "doc_id long, text string",
    )
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs, counts=True).collect()}
    assert got[1]["n_dropped"] == 0 and got[2]["text"] == "short\nother words of two" and got[3]["text"] is None
    assert line_dedup.dedup_lines(awkward).columns == awkward.columns
    assert line_dedup.dedup_lines(awkward).count() == len(AWKWARD)
    assert line_dedup.dedup_lines(empty).count() == 0


def test_leaks(spark, awkward, empty):
    words = [f"w{k}" for k in range(400)]
    draw = random.Random(8)
    items = [(k, " ".join(draw.choice(words) for _ in range(30)) + ". the answer is " + words[k]) for k in range(5)]
    benchmark = spark.createDataFrame([*items, (9, None)], "item_id long, text string")
    filler = " ".join(f"f{draw.randint(0, 9999)}" for _ in range(300))
    changed = items[1][1].split()
    changed[3], changed[12] = "other", "else"
    docs = [(0, filler), (1, filler + " " + items[0][1] + " " + filler), (2, " ".join(changed) + " " + filler), (3, None)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, benchmark).collect()}
    assert got == {(1, 0), (2, 1)}
    assert sorted(r["doc_id"] for r in decontaminate.clean(docs, benchmark).collect()) == [0, 3]
    assert decontaminate.clean(awkward, benchmark).count() == len(AWKWARD)
    assert decontaminate.leaks(empty, benchmark).count() == 0
    assert decontaminate.leaks(docs, benchmark.limit(0)).count() == 0


def test_common_subsequence():
    draw = random.Random(9)
    for _ in range(200):
        one = [draw.choice("abcd") for _ in range(draw.randint(1, 9))]
        two = [draw.choice("abcd") for _ in range(draw.randint(0, 9))]
        assert decontaminate.in_order(one, two) == len(decontaminate.matched_places(one, two))
