"""Line dedup next to edit distances of all pairs, and its recall."""

import random

from pyspark.sql import functions as F

from tabml.llm import line_dedup

SCHEMA = "doc_id long, text string, n_lines int, part string"


def edits(one: str, two: str) -> int:
    row = list(range(len(two) + 1))
    for i, a in enumerate(one, 1):
        before, row[0] = row[0], i
        for j, b in enumerate(two, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (a != b))
    return row[-1]


def vocabulary(draw):
    return ["".join(draw.choice("abcdefghijklmnoprstu") for _ in range(draw.randint(2, 9))) for _ in range(3000)]


def test_recall_of_one_changed_character(spark):
    draw = random.Random(5)
    words, found = vocabulary(draw), {}
    for size in (40, 120):
        rows = []
        for k in range(100):
            line = [draw.choice(words) for _ in range(size)]
            other = list(line)
            place = draw.randrange(size)
            other[place] = "x" + other[place][1:]
            rows += [(2 * k, " ".join(line), 1, "p"), (2 * k + 1, " ".join(other), 1, "p")]
        got = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA), empty=False)
        found[size] = 2 * 100 - got.count()
    assert found[40] >= 45 and found[120] >= 80


def test_only_similar_lines_go(spark):
    draw = random.Random(6)
    words = vocabulary(draw)
    lines = []
    for _ in range(25):
        line = [draw.choice(words) for _ in range(draw.randint(3, 30))]
        for _ in range(4):
            other = [draw.choice(words) if draw.random() < 0.15 else w for w in line]
            lines.append(" ".join(other))
    rows = [(k, line, 1, "p") for k, line in enumerate(lines)]
    frame = spark.createDataFrame(rows, SCHEMA)
    kept = {r["doc_id"] for r in line_dedup.dedup_lines(frame, empty=False).collect()}
    # A line goes only if a chain of links leads to an earlier line that stays.
    linked = {k: k for k in range(len(lines))}

    def root(k):
        return k if linked[k] == k else root(linked[k])

    for a in range(len(lines)):
        for b in range(a):
            if 100 * edits(lines[a], lines[b]) <= 20 * max(len(lines[a]), len(lines[b])):
                linked[max(root(a), root(b))] = min(root(a), root(b))
    for k in set(range(len(lines))) - kept:
        assert any(root(k) == root(other) and other < k for other in kept)


def test_lines_of_a_template_are_not_paired_with_each_other(spark):
    counts = {}
    for n in (200, 800):
        rows = [(k, f"the opening hours of the largest book shop in our old town are number {k}", 1, "p") for k in range(n)]
        lines = line_dedup.line_table(spark.createDataFrame(rows, SCHEMA), "text", "doc_id")
        distinct = lines.groupBy("node").agg(F.bit_or("sim").alias("sim"), F.first("n_chars").alias("n_chars"))
        counts[n] = line_dedup.first_candidates(distinct).count()
        assert line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA), empty=False).count() < 0.1 * n
    assert counts[800] < 5 * counts[200] and counts[800] < 800


def test_wide_lines_and_names(spark, monkeypatch):
    draw = random.Random(7)
    words = vocabulary(draw)
    long = " ".join(draw.choice(words) for _ in range(3000))
    rows = [(1, long, 5, "x"), (2, long.replace(words[0], "other"), 6, "x"), (3, long[:-1] + "q", 7, "x"), (4, None, 8, "x")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA), counts=True)
    assert got.columns == ["doc_id", "text", "n_lines", "part", "n_lines_", "n_dropped"]
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"]) for r in got.collect()} == {1: (5, 0), 2: (6, 1), 3: (7, 1), 4: (8, 0)}
    # Broadcast or not, narrow sums or wide ones: the same lines.
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", 0)
    again = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA), counts=True)
    assert again.exceptAll(got).count() == 0 and line_dedup.dedup_lines(got.limit(0)).count() == 0


def test_few_words_on_demand(spark):
    frame = spark.createDataFrame([(1, "one\ntwo words", 1, "p"), (2, "ONE.\n\ntwo words", 1, "p")], SCHEMA)
    assert line_dedup.dedup_lines(frame).filter("doc_id = 2").first()["text"] == "ONE.\n\ntwo words"
    assert line_dedup.dedup_lines(frame, least_words=1).filter("doc_id = 2").first()["text"] == ""


def test_near_copies_of_one_line_leave_few_pairs(spark, monkeypatch):
    draw = random.Random(8)
    words, left = vocabulary(draw), {}
    line = [draw.choice(words) for _ in range(60)]
    plain = line_dedup.candidates

    def counted(lines):
        pairs = plain(lines)
        left[n] = pairs.count()
        return pairs

    monkeypatch.setattr(line_dedup, "candidates", counted)
    for n in (200, 800):
        rows = []
        for k in range(n):
            other = list(line)
            for place in draw.sample(range(60), 2):
                other[place] = draw.choice(words)
            rows.append((k, " ".join(other), 1, "p"))
        assert line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA), empty=False).count() <= 0.2 * n
    assert left[800] <= 8 * max(left[200], 100)


def test_frequent_words_do_not_make_unlike_lines_candidates(spark):
    draw = random.Random(9)
    words = vocabulary(draw)
    rows = []
    for k in range(400):
        line = [draw.choice(words) for _ in range(45)] + ["the"] * 30
        draw.shuffle(line)
        rows.append((k, " ".join(line), 1, "p"))
    lines = line_dedup.line_table(spark.createDataFrame(rows, SCHEMA), "text", "doc_id")
    distinct = lines.groupBy("node").agg(F.bit_or("sim").alias("sim"), F.first("n_chars").alias("n_chars"))
    assert line_dedup.candidates(distinct.withColumn("label", F.col("node"))).count() < 10


def test_edits_are_counted_to_the_bound(spark):
    draw = random.Random(10)
    words = vocabulary(draw)
    line = " ".join(draw.choice(words) for _ in range(250))
    rows = [(0, line, 1, "p")]
    for k, share in enumerate((0.001, 0.01, 0.05, 0.12, 0.18, 0.21, 0.3), 1):
        other = list(line)
        for place in draw.sample([i for i, letter in enumerate(line) if letter != " "], int(share * len(line))):
            other[place] = "z"
        rows.append((k, "".join(other), 1, "p"))
    docs = spark.createDataFrame(rows, SCHEMA)
    lines = line_dedup.line_table(docs, "text", "doc_id").select("id", "mark", "pos", "node")
    distinct = lines.select("node", F.struct("id", "mark", "pos").alias("first")).cache()
    first = distinct.filter("first.id = 0").select(F.col("node").alias("a"))
    pairs = first.crossJoin(distinct.filter("first.id > 0").select(F.col("node").alias("b")))
    found = line_dedup._links(pairs, distinct, docs, "text", "doc_id").join(distinct, F.col("b") == F.col("node"))
    want = {k for k, text, *_ in rows[1:] if 100 * edits(line, text) <= 20 * len(line)}
    assert {r["id"] for r in found.select("first.id").collect()} == want and len(want) == 5
