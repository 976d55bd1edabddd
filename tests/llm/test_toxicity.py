"""The chain against sums over all labellings, and scores on documents held out."""

import itertools
import random
import zlib

import numpy as np
import pytest

from reportmart.llm import toxicity
from reportmart.llm.toxicity import Steps, ToxicityModel, passes

SF_DIR = "/root/testdata/sf0.1"


def test_marginals_are_exact():
    rng = np.random.default_rng(1)
    evidence = [rng.normal(size=n) for n in (3, 0, 7, 1, 7, 5)]
    model = ToxicityModel(start=0.3, move=np.array([[1.5, 0.2], [0.7, 2.5]]))
    for e, p in zip(evidence, model.probabilities(evidence)):
        weight = np.zeros(len(e))
        total = 0.0
        for states in itertools.product((0, 1), repeat=len(e)):
            w = np.exp(sum(x for x, s in zip(e, states) if s))
            w *= 0.3 if states and states[0] else 1
            for a, b in zip(states, states[1:]):
                w *= model.move[a, b]
            total += w
            weight += w * np.array(states, float)
        assert np.allclose(p, weight / total)


def test_steps_cover_every_token():
    steps = Steps(np.array([2, 0, 5, 2]))
    assert sorted(steps.place.tolist()) == list(range(9))
    assert [high - low for low, high in steps.spans()] == [3, 3, 1, 1, 1]
    forward, backward = passes(np.ones(9), steps, 1.0, np.ones((2, 2)))
    assert (forward == 1).all() and (backward == 1).all()


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(5, 80))
        toxic = rng.random() < 0.2
        if toxic:
            at = rng.randrange(len(text))
            text[at:at] = [rng.choice(["Zounds,", "zounds", "fiends!", "fiendish"]), "you"]
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def trained(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    return toxicity.train(docs, marks), rows, labels


def test_learns_and_generalises(spark, clashing, trained):
    model, _, _ = trained
    rows, labels = corpus(seed=2)
    found = {r.doc_id: r for r in toxicity.score(clashing(rows), model).collect()}
    for i, label in labels:
        assert found[i].predicted == label, rows[i]
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    for i, text in rows:
        marked = [text[s.start : s.end] for s in found[i].spans]
        assert all(("ounds" in m) or ("fiend" in m) for m in marked)
        assert bool(marked) == bool(labels[i][1])


def test_odd_rows(spark, clashing, trained):
    model, _, _ = trained
    long = "abc " * 60_000 + "zounds"
    rows = [(None, None), (1, None), (1, ""), (2, " \n"), (3, long), (4, "x" * 300_000)]
    docs = clashing(rows)
    found = toxicity.score(docs, model).collect()
    assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
    span = next(r for r in found if r.doc_id == 3).spans[0]
    assert long[span.start : span.end] == "zounds"
    assert toxicity.score(clashing([]), model).collect() == []
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} >= {None, 1, 2, 4}
    assert toxicity.without_toxic(clashing([]), model).collect() == []


def test_labels_held_out_are_not_learnt(spark, trained):
    _, rows, labels = trained
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def turned(i, label):
        return 1 - label if zlib.crc32(str(i).encode()) % 4 == 2 else label

    models = [
        toxicity.train(docs, spark.createDataFrame(marks, "doc_id long, toxic int"))
        for marks in (labels, [(i, turned(i, x)) for i, x in labels])
    ]
    assert models[0].weights == models[1].weights
    assert (models[0].document == models[1].document).all()


def test_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for marks in (none, spark.createDataFrame([(0, 0), (1, 0), (None, 1), (5, None)], none.schema)):
        model = toxicity.train(documents(["a b", "c"]), marks)
        found = toxicity.score(documents(["a b", "", None]), model).collect()
        assert len({r.score for r in found}) == 1
        assert all(0 < r.score <= 0.5 for r in found)


def test_held_out_accuracy_on_the_given_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = toxicity.train(docs, labels)
    found = toxicity.score(docs, model).where("held_out").join(labels, "doc_id").collect()
    hit = sum(r.predicted and r.toxic for r in found)
    assert hit >= 0.85 * sum(r.toxic for r in found)
    assert hit >= 0.9 * sum(r.predicted for r in found)
