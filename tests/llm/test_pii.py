"""The tagger of personal data: what it adds, what it leaves alone, and which lines it decodes."""

import random

import pytest

from tabml.llm import pii, pii_table

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def tagger():
    return pii.Tagger(pii.train(pii.labelled_lines()))


def added(tagger, text):
    [(_, spans)] = pii.all_spans([text], tagger)
    return [(kind, text[start:end]) for kind, start, end in spans]


def with_check_digit(digits):
    return next(digits + str(last) for last in range(10) if pii.luhn(digits + str(last)))


def drawn(draw):
    """Personal data in forms that the fixed patterns do not read, with new digits and names."""
    d = lambda n: "".join(draw.choice("123456789") for _ in range(n))
    name = "".join(draw.choice("abcdefgh") for _ in range(draw.randint(3, 9)))
    card = with_check_digit("4" + d(14))
    return [
        ("phone", f"({d(3)}) {d(3)}-{d(4)}"),
        ("phone", f"{d(3)}-{d(3)}-{d(4)}"),
        ("phone", f"{d(3)}.{d(3)}.{d(4)}"),
        ("phone", f"00{d(2)} {d(2)} {d(7)}"),
        ("phone", f"0{d(3)}/{d(7)}"),
        ("card", ".".join(card[k : k + 4] for k in range(0, 16, 4))),
        ("card", " - ".join(card[k : k + 4] for k in range(0, 16, 4))),
        ("email", f"{name}@{name}ä.de"),
        ("email", f"{name}(at){name}.com"),
        ("email", f"{name} [at] {name} [dot] org"),
        ("ip", "[.]".join(str(draw.randint(1, 255)) for _ in range(4))),
    ]


def unlike(draw):
    n = lambda a, b: draw.randint(a, b)
    return [
        f"{n(1990, 2030)}-{n(10, 12)}-{n(10, 28)} {n(10, 23)}:{n(10, 59)}:{n(10, 59)}",
        f"{n(10, 28)}.{n(10, 12)}.{n(1990, 2030)} - {n(10, 28)}.{n(10, 12)}.{n(1990, 2030)}",
        f"{n(10**9, 10**10 - 1)}",
        f"{n(100, 999)} {n(100, 999)} {n(100, 999)} {n(100, 999)}",
        f"isbn 978-{n(1, 9)}-{n(10, 99)}-{n(100000, 999999)}-{n(0, 9)}",
        f"0.{n(10**9, 10**10)}",
        f"order {n(10**9, 10**10 - 1)}",
        f"pkg@v{n(1, 9)}",
        f"{n(1900, 1999)} {n(1900, 1999)} {n(1900, 1999)}",
    ]


AROUND = ("he wrote {} on the door", "{}", "ask for {} or leave", "ein Satz mit {} darin .")


def test_finds_drawn_forms_and_leaves_look_alikes(tagger):
    draw = random.Random(8)
    right = wanted = wrong = 0
    for _ in range(100):
        for kind, value in drawn(draw):
            got = added(tagger, draw.choice(AROUND).format(value))
            wanted += 1
            right += got == [(kind, value)]
            wrong += any(g != (kind, value) for g in got)
        for value in unlike(draw):
            wrong += bool(added(tagger, draw.choice(AROUND).format(value)))
    assert right / wanted >= 0.97, right / wanted
    assert right / (right + wrong) >= 0.97, wrong


def test_forms_left_out_of_the_table_are_found():
    """Each form in turn is kept from training, and then looked for: under half are found whole."""
    found = total = 0
    for kind, texts in pii_table.FORMS.items():
        for text in texts[:6]:
            if pii.base_spans(text):
                continue
            forms = {k: tuple(t for t in v if t != text) for k, v in pii_table.FORMS.items()}
            lines = [(line.split(), pii.word_labels(line, spans)) for line, spans in pii_table.marked_lines(forms)]
            tagger = pii.Tagger(pii.train(lines, rounds=6))
            total += 1
            found += added(tagger, f"so {text} it is") == [(kind, text)]
    assert total >= 15 and found / total >= 0.4, (found, total)


def test_decoding_few_lines_is_decoding_all(tagger):
    draw = random.Random(5)
    parts = ["4111.1111.1111.1111", "(212) 555-", "9876", " ", "\n", "a@b.co", "x@ö.de", "[at]", "(.)", "8", "[.]", "+1 2", "0049 30 123", "é", "(at)b.c", "-", "1.2.3.4", "@"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 14))) for _ in range(6000)]
    texts += [v for _ in range(50) for _, v in drawn(draw)]
    few, every = pii.all_spans(texts, tagger), pii.all_spans(texts, tagger, every_line=True)
    assert few == every
    assert sum(len(more) for _, more in few) > 500


def test_taken_places():
    draw = random.Random(2)
    for _ in range(500):
        base = [("ip", a, a + draw.randint(1, 6)) for a in (draw.randint(0, 40) for _ in range(draw.randint(0, 6)))]
        taken = pii._Taken(base)
        for _ in range(20):
            start = draw.randint(0, 45)
            end = start + draw.randint(1, 5)
            assert taken.meets(start, end) == any(a < end and start < b for _, a, b in base)


def test_spans_of_a_table(spark):
    rows = [
        (1, "é call (212) 555-9876 now"), (2, "a@b.co"), (3, None), (None, "tel 2125550142\nx"), (2, "a@b.co"), (4, ""),
        (5, "word " * 30_000 + "(212) 555-9876"), (6, "9" * 200_000), (7, "a" * 100_000 + "@" + "ö" * 1000 + ".de"),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS id", "1 AS spans", "2 AS words")
    got = [(r["doc_id"], r["spans"], r["n_phone"], r["n_added"]) for r in pii.find(docs).collect()]
    assert len(got) == len(rows)
    by = {g[0]: g[1:] for g in got}
    assert by[1] == ("phone:7:21", 0, 1) and by[2] == ("email:0:6", 0, 0)
    assert by[3] == by[4] == by[6] == ("", 0, 0)
    assert by[None] == ("phone:4:14", 0, 1)
    assert by[5] == ("phone:150000:150014", 0, 1)
    assert [g for g in got if g[0] == 2] == [(2, "email:0:6", 0, 0)] * 2
    assert pii.find(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_table_without_spans_adds_nothing(spark):
    lines = [("nothing to see here".split(), [0] * 4)]
    docs = spark.createDataFrame([(1, "(212) 555-9876")], SCHEMA)
    assert [r["n_added"] for r in pii.find(docs, lines).collect()] == [0]
