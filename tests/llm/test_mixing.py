import math
import random

import pytest

from filelake.llm import mixing


def corpus(n=900, seed=2):
    random.seed(seed)
    rows = [(i, " ".join(["w"] * random.randint(1, 40)), random.choice(["big"] * 12 + ["mid"] * 3 + ["tiny"])) for i in range(n)]
    return rows + [(5000, None, "mid"), (5001, "", "tiny"), (5002, "a b", None), (7, rows[7][1], rows[7][2]), (None, "x y z", "big"), (5003, "", "blank")]


def sums(rows):
    total = {}
    for _, text, source in rows:
        total[source] = total.get(source, 0) + (len(text.split()) if text else 0)
    return total


def weights(total, power):
    raised = {s: (t / sum(total.values())) ** power for s, t in total.items() if t}
    return {s: x / sum(raised.values()) for s, x in raised.items()}


def entropy(w):
    return -sum(x * math.log(x) for x in w.values()) / math.log(len(w))


def sources(spark, total):
    return spark.createDataFrame([(str(s), t) for s, t in total.items()], "_source string, tokens long")


def test_exponent_meets_entropy(spark):
    total = {"a": 10_000, "b": 900, "c": 50, "d": 0}
    for target in (0.5, 0.8, 0.99, 1.0):
        power = mixing.exponent(sources(spark, total), target_entropy=target)
        assert entropy(weights(total, power)) == pytest.approx(max(target, entropy(weights(total, 1))), abs=1e-6)
    assert mixing.exponent(sources(spark, total)) == 1.0
    # Entropy is large enough as it is.
    assert mixing.exponent(sources(spark, {"a": 5, "b": 5}), target_entropy=0.9) == 1.0


def test_exponent_keeps_the_limit_of_repetition(spark):
    total = {"a": 10_000, "b": 900, "c": 50}
    for limit in (1.5, 4.0, 30.0):
        power = mixing.exponent(sources(spark, total), target_entropy=1.0, max_repetition=limit)
        w = weights(total, power)
        ratio = {s: w[s] / t for s, t in total.items()}
        assert max(ratio.values()) / min(ratio.values()) == pytest.approx(limit, rel=1e-6)
    power = mixing.exponent(sources(spark, total), target_entropy=1.0, max_repetition=3.0, budget=20_000)
    w = weights(total, power)
    assert max(20_000 * w[s] / t for s, t in total.items()) == pytest.approx(3.0, rel=1e-6)
    assert mixing.exponent(sources(spark, {"a": 0}), 1.0, 2.0) == 1.0


@pytest.mark.parametrize("budget", [None, 6000])
def test_uses_follow_the_weights(docs, budget):
    rows = corpus()
    total = sums(rows)
    found = mixing.mix(docs(rows), target_entropy=0.9, max_repetition=3.0, budget=budget, block=50).collect()
    power = None
    uses, tokens = {}, {}
    for r in found:
        key = (r["doc_id"], r["text"], r["source"])
        uses.setdefault(key, []).append(r["pass"])
        tokens[r["source"]] = tokens.get(r["source"], 0) + (len(r["text"].split()) if r["text"] else 0)
        assert 0 <= r["place"] <= 1
    spent = sum(tokens.values())
    share = {s: t / spent for s, t in tokens.items() if t}
    # The exponent that the realised shares give, from the two largest sources, fits the third too.
    power = math.log(share["big"] / share["mid"]) / math.log(total["big"] / total["mid"])
    expected = weights(total, power)
    for s in share:
        assert share[s] == pytest.approx(expected[s], abs=0.02)
    rates = {s: tokens[s] / t for s, t in total.items() if t}
    assert max(rates.values()) <= 3.0 + 1e-6
    if budget is None:
        assert set(uses) == {(i, t, s) for i, t, s in rows} and min(rates.values()) == pytest.approx(1.0, abs=1e-6)
    else:
        assert spent <= budget and spent > 0.97 * budget
    repeated = (7, rows[7][1], rows[7][2])
    for key, passes in uses.items():
        times = 2 if key == repeated else 1
        assert sorted(passes) == sorted(list(range(len(passes) // times)) * times)


def test_partial_pass_takes_whole_blocks_first(spark, docs):
    rows = [(i, "a b c d", "s") for i in range(400)]
    found = mixing.mix(docs(rows), budget=800.0, block=20).collect()
    assert len(found) == 200 and len({r["doc_id"] for r in found}) == 200
    again = mixing.mix(docs(rows), budget=800.0, block=20).collect()
    assert {r["doc_id"] for r in found} == {r["doc_id"] for r in again}
    other = mixing.mix(docs(rows), budget=800.0, block=20, seed=99).collect()
    assert {r["doc_id"] for r in found} != {r["doc_id"] for r in other}
    places = [r["place"] for r in sorted(found, key=lambda r: r["place"])]
    assert places == [i * 4 / 800 for i in range(200)]


def test_no_rows_and_no_tokens(docs):
    assert mixing.mix(docs([]), target_entropy=0.9, max_repetition=2.0).count() == 0
    assert mixing.mix(docs([(1, None), (2, "")]), target_entropy=0.9, max_repetition=2.0).count() == 2
