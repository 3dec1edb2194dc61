"""The trained models next to plain versions: Kneser-Ney, label model, linear scorer."""

import collections
import math

import numpy as np

from tabml.llm import language, quality


def plain_kneser_ney(counts):
    """Probability of a gram by the definition, over dictionaries."""
    size = language.ORDER
    weights = {size: dict(counts)}
    for k in range(size - 1, 0, -1):
        weights[k] = collections.Counter(gram[1:] for gram in weights[k + 1])
    discount = {}
    for k, own in weights.items():
        once, twice = (sum(v == n for v in own.values()) for n in (1, 2))
        discount[k] = once / (once + 2 * twice) if once else 0.5

    def probability(gram):
        k = len(gram)
        if not k:
            return 1 / language.CLASSES
        after = [v for g, v in weights[k].items() if g[:-1] == gram[:-1]]
        if not after:
            return probability(gram[1:])
        seen = max(weights[k].get(gram, 0) - discount[k], 0)
        return (seen + discount[k] * len(after) * probability(gram[1:])) / sum(after)

    return probability


def packed(gram):
    out = 0
    for character in gram:
        out = out << language.BITS | character
    return out


def toy(draw, number, classes):
    counts = collections.Counter(tuple(g) for g in draw.integers(0, classes, (number, language.ORDER)).tolist())
    grams = sorted(counts, key=packed)
    model = language.kneser_ney(np.array([packed(g) for g in grams]), np.array([counts[g] for g in grams]))
    return counts, model


def test_scores_are_kneser_ney_by_definition():
    draw = np.random.default_rng(6)
    toys = {"a": toy(draw, 60, 4), "b": toy(draw, 200, 6), "c": toy(draw, 3, 9)}
    model = language._merged({name: own for name, (_, own) in toys.items()})
    grams = [tuple(g) for g in draw.integers(0, 12, (600, language.ORDER)).tolist()] + list(toys["a"][0])
    got = model.score(np.array([packed(g) for g in grams]))
    for column, name in enumerate(model.languages):
        probability = plain_kneser_ney(toys[name][0])
        want = [math.log(probability(g)) for g in grams]
        np.testing.assert_allclose(got[:, column], want, atol=2e-4)


def test_probabilities_after_a_context_sum_to_one():
    draw = np.random.default_rng(7)
    counts, own = toy(draw, 300, 5)
    model = language._merged({"x": own})
    for context in [*list(counts)[:20], (8, 8, 8, 8)]:
        grams = np.array([packed((*context[1:], c)) for c in range(language.CLASSES)])
        assert abs(np.exp(model.score(grams)).sum() - 1) < 1e-3


def test_equal_languages_tie_to_the_first(spark):
    rows = [(k, "abc abd bcd " * 5, lang) for k, lang in enumerate(["zz", "aa"] * 10)]
    rows += [(100, "abc abd", None), (101, None, "aa"), (102, "12 34", "zz"), (103, "abc " * 20_000, None), (100, "abc abd", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'x' AS id", "1 AS entropy")
    got = language.identify(docs).collect()
    assert len(got) == len(rows)
    assert {r["lang_pred"] for r in got} == {"aa", "und"}
    assert {r["doc_id"] for r in got if r["lang_pred"] == "und"} == {101, 102}
    assert len({(r["lang_pred"], r["score"]) for r in got if r["doc_id"] == 100}) == 1


def drawn_votes(draw, number):
    rates = np.array([[[0.1, 0.6, 0.3], [0.15, 0.5, 0.35], [0.05, 0.75, 0.2]], [[0.7, 0.05, 0.25], [0.6, 0.1, 0.3], [0.8, 0.05, 0.15]]])
    vote = {quality.GOOD: 0, quality.BAD: 1, quality.ABSTAIN: 2}
    truth = (draw.random(number) < 0.7).astype(int)
    order = sorted(vote, key=lambda v: vote[v])
    votes = np.stack([[draw.choice(order, p=rates[t, k]) for t in truth] for k in range(3)], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    return rates, vote, patterns, counts.astype(float)


def objective(prior, rates, patterns, counts):
    """Log posterior of the label model: likelihood, and one vote more of each kind."""
    sides = []
    for side, share in ((0, 1 - prior), (1, prior)):
        chance = np.full(len(patterns), share)
        for k in range(patterns.shape[1]):
            chance = chance * rates[side, k, patterns[:, k]]
        sides.append(chance)
    return counts @ np.log(sides[0] + sides[1]) + np.log(rates).sum() + np.log(prior) + np.log(1 - prior)


def test_label_model_is_a_maximum_and_finds_the_rates():
    draw = np.random.default_rng(1)
    true, vote, patterns, counts = drawn_votes(draw, 20_000)
    model = quality.expectation_maximisation(patterns, counts, rounds=5000)
    assert abs(model.prior - 0.7) < 0.05
    for value, place in vote.items():
        assert np.abs(model.rates[:, :, value] - true[:, :, place]).max() < 0.06
    best = objective(model.prior, model.rates, patterns, counts)
    for size in (0.3, 0.05, 0.01):
        for _ in range(300):
            rates = model.rates * np.exp(size * draw.normal(size=model.rates.shape))
            rates /= rates.sum(axis=2, keepdims=True)
            odds = math.log(model.prior / (1 - model.prior)) + size * draw.normal()
            assert objective(1 / (1 + math.exp(-odds)), rates, patterns, counts) <= best + 1e-3


def test_scorer_reaches_the_least_loss():
    draw = np.random.default_rng(2)
    examples = [(np.array([3, 8, 20]), draw.normal(size=3)) for _ in range(200)]
    matrix = np.stack([v for _, v in examples])
    targets = 1 / (1 + np.exp(-(matrix @ [1.0, -2.0, 0.5] + 0.3)))
    weights = draw.random(200) + 0.5
    scorer = quality.train(examples, targets, weights)
    share, design = weights / weights.sum(), np.column_stack([matrix, np.ones(200)])
    found = np.zeros(4)
    for _ in range(50):
        chance = 1 / (1 + np.exp(-design @ found))
        slope = design.T @ (share * (chance - targets)) + 1e-5 * np.append(found[:3], 0)
        bend = design.T @ (design * (share * chance * (1 - chance))[:, None]) + 1e-5 * np.diag([1, 1, 1, 0])
        found -= np.linalg.solve(bend, slope)
    np.testing.assert_allclose([*scorer.weights[[3, 8, 20]], scorer.bias], found, atol=0.02)


def test_equal_texts_score_alike(spark):
    texts = ["some plain words that say a thing or two here", "!!! @@ ## $$", "word " * 50_000, "", None]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts * 4)], "doc_id long, text string").selectExpr("*", "0 AS code", "'x' AS id")
    _, scorer = quality.fit(docs)
    got = docs.select("text", quality.score_column(docs, scorer).alias("s")).distinct().collect()
    assert len(got) == len(texts)
    assert [r["s"] for r in got if not r["text"]] == [0.0, 0.0]


def test_every_labelled_text_calibrates(spark):
    draw = np.random.default_rng(5)
    letters = {"aa": "abcdefgh", "zz": "efghijkl"}
    rows = [(k, "".join(draw.choice(list(letters[lang]), 12)), lang) for k, lang in enumerate(["aa", "zz"] * 1300)]
    rows += [(5000 + k, "".join(draw.choice(list("mnopqrst"), 9)), "aa") for k in range(4)]
    frame = spark.createDataFrame(rows, "id long, text string, lang string")
    model = language.fit(frame)
    seen = language.entropies(frame, model).collect()
    for column, name in enumerate(model.languages):
        own = np.array([r["entropy"][column] for r in seen if r["lang"] == name])
        limit = np.quantile(own, 1 - language.FALSE_REJECTIONS, method="inverted_cdf") + own.std()
        assert math.isclose(model.reject_above[column], limit, rel_tol=1e-9), name

    def loss(temperature):
        total = 0.0
        for r in seen:
            scaled = [-e * temperature for e in r["entropy"]]
            top = max(scaled)
            total += math.log(sum(math.exp(s - top) for s in scaled)) + top - scaled[model.languages.index(r["lang"])]
        return total

    assert model.temperature == min(language.TEMPERATURES, key=loss)
    assert language._calibrated(model, language.entropies(frame.limit(0), model)).reject_above.tolist() == [math.inf] * 2
