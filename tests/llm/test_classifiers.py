"""Quality and toxicity: held-out accuracy, odd rows, what may teach."""

import zlib

import numpy as np
import pytest

from innledger.llm import quality, toxicity
from innledger.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"
CASES = [("op8_quality_classifier", "quality", 0.98), ("op4_toxicity", "toxic", 0.95)]


@pytest.mark.parametrize("query, label, least", CASES)
def test_held_out_rows(spark, query, label, least):
    got = QUERIES[query](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = got.join(labels, "doc_id").filter("held_out").collect()
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len(rows) > 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    right = np.mean([r.predicted == r[label] for r in rows])
    assert right >= least
    assert all(0 <= r.score <= 1 for r in rows)


DOCS = "doc_id long, text string, score string, label int, slots int"


@pytest.mark.parametrize("classifier, label", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_rows_and_columns(spark, classifier, label):
    good, bad = "calm plain words here ", "xx%% yy%% vilest vilest zz%% "
    bad_is = 0 if label == "quality" else 1
    rows = [(i, (bad if i % 2 else good) * (1 + i % 3), "s", 0, 1) for i in range(200)]
    odd = [(500, None, None, None, None), (501, "", None, None, None), (None, bad, "x", 1, 1)]
    odd += [(502, bad * 40000, "x", 1, 1)] + [(503, good, "x", 1, 1)] * 2
    docs = spark.createDataFrame(rows + odd, DOCS)
    marks = [(i, bad_is if i % 2 else 1 - bad_is) for i in range(200)]
    labels = spark.createDataFrame([*marks, (None, 1), (0, None)], f"doc_id long, {label} int")
    got = classifier.scored(docs, classifier.trained(docs, labels), "p").collect()
    assert len(got) == len(rows) + len(odd)
    by_id = {r.doc_id: r for r in got}
    assert [by_id[k].score for k in (0, 500)] == ["s", None]
    high, low = (503, 502) if label == "quality" else (502, 503)
    assert by_id[high].p > 0.9 and by_id[low].p < 0.3
    assert (by_id[None].p > 0.5) == (label == "toxic")
    assert 0 <= by_id[500].p == by_id[501].p <= 1
    assert len({r.p for r in got if r.doc_id == 503}) == 1


@pytest.mark.parametrize("classifier, label", [(quality, "quality"), (toxicity, "toxic")])
def test_empty_tables(spark, classifier, label):
    docs = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], f"doc_id long, {label} int")
    model = classifier.trained(docs, labels)
    assert classifier.scored(docs, model, "p").collect() == []
    one = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    assert 0 <= classifier.scored(one, classifier.trained(one, labels), "p").first().p <= 0.5


def test_held_out_labels_teach_nothing(spark):
    """Turning the labels of held-out rows around changes no score."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.selectExpr(
        "doc_id",
        "if(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, 1 - quality, quality) quality",
    )
    a, b = quality.trained(docs, labels), quality.trained(docs, turned)
    assert a["intercept"] == b["intercept"] and (a["weights"] == b["weights"]).all()


def test_risk_does_not_go_below_zero():
    """Unlabelled toxic documents, as many as the prior says, are called toxic too."""
    rng = np.random.default_rng(0)
    toxic = (rng.random((300, 5)) < 0.6).astype(np.float32)
    clean = (rng.random((900, 5)) < 0.02).astype(np.float32)
    hidden = (rng.random((100, 5)) < 0.6).astype(np.float32)
    w, b = toxicity.non_negative_pu(toxic, np.concatenate([clean, hidden]), 0.1)
    assert np.mean(hidden @ w + b > 0) > 0.9 and np.mean(clean @ w + b > 0) < 0.12


def test_ftrl_against_a_plain_loop():
    """One coordinate after the other, as the update is written down."""
    rng = np.random.default_rng(4)
    examples = [
        (int(rng.random() < 0.5), np.sort(rng.choice(30, 6, replace=False)), rng.random(6) * quality.SCALE)
        for _ in range(40)
    ]
    z, n = [0.0] * 31, [0.0] * 31

    def weight(i):
        least = 0.0 if i == 30 else quality.L1
        if abs(z[i]) <= least:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * least) / ((quality.BETA + n[i] ** 0.5) / quality.ALPHA + quality.L2)

    for _ in range(quality.EPOCHS):
        for label, slots, values in examples:
            x = [*zip(slots.tolist(), values.tolist(), strict=True), (30, 1.0)]
            own = {i: weight(i) for i, _ in x}
            p = 1 / (1 + np.exp(-sum(own[i] * v for i, v in x)))
            for i, v in x:
                g = (p - label) * v
                sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / quality.ALPHA
                z[i] += g - sigma * own[i]
                n[i] += g * g
    weights, intercept = quality.ftrl(examples, 30)
    assert np.allclose(weights, [weight(i) for i in range(30)], rtol=1e-5, atol=1e-7)
    assert np.isclose(intercept, weight(30)) and np.abs(weights).max() > 0


def test_scores_are_sparse_dot_products(spark):
    """Each score again from the distinct n-grams of its text, with dictionaries."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    model = quality.trained(docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    weight = dict(zip(model["slots"].tolist(), model["weights"].tolist(), strict=True))
    assert weight
    for row in quality.scored(docs, model, "p").collect():
        hashed, _ = quality._ngrams(*quality._token_codes([(row.text or "").encode()]))
        slots = hashed.tolist()
        share = quality.SCALE / max(1, len(slots))
        total = model["intercept"] + sum(weight.get(s, 0.0) * share for s in slots)
        assert abs(row.p - 1 / (1 + np.exp(-total))) < 1e-4


@pytest.mark.parametrize("prior", [0.1, 0.8])
def test_pu_steps_follow_the_risk(monkeypatch, prior):
    """Sixty steps against differences of the risk; with a high prior its second part is negative."""
    monkeypatch.setattr(toxicity, "STEPS", 60)
    rng = np.random.default_rng(6)
    positive, mixture = (rng.random((n, 4)) < q for n, q in ((40, 0.6), (90, 0.2)))

    def loss(x, at, sign):
        return np.mean([1 / (1 + np.exp(sign * (row @ at[:-1] + at[-1]))) for row in x])

    def slope(part, at):
        steps = np.eye(len(at)) * 1e-6
        return np.array([(part(at + d) - part(at - d)) / 2e-6 for d in steps])

    def first(at):
        return prior * loss(positive, at, 1)

    def second(at):
        return loss(mixture, at, -1) - prior * loss(positive, at, -1)

    at, mean, square = np.array([0.0] * 4 + [-1.0]), np.zeros(5), np.zeros(5)
    negative = []
    for step in range(1, 61):
        negative.append(second(at) < 0)
        grad = -slope(second, at) if negative[-1] else slope(first, at) + slope(second, at)
        grad[:-1] += toxicity.DECAY * at[:-1]
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        at = at - toxicity.RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        at[:-1] = np.maximum(at[:-1], 0)
    w, b = toxicity.non_negative_pu(positive.astype(np.float32), mixture.astype(np.float32), prior)
    assert np.allclose([*w, b], at, atol=1e-3)
    assert any(negative) == (prior == 0.8), negative
