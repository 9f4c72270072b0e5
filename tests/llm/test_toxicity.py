"""Toxicity: label model on simulated voters, held-out accuracy, bounds and edge cases."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clearshelf.llm import toxicity as tx

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    clean = ["".join(rng.choices(["ba", "no", "ri", "tel", "mu"], k=rng.randrange(1, 4))) for _ in range(300)]
    insults = ["grobix", "flenko", "varduk"]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(clean, k=rng.randrange(20, 120))
        toxic = int(rng.random() < 0.15)
        for _ in range(toxic * rng.randrange(2, 6)):
            word = rng.choice(insults) if rng.random() < 0.5 else "zwog" + rng.choice(clean)
            words.insert(rng.randrange(len(words)), word)
        rows.append((i, " ".join(words).capitalize() + "."))
        if rng.random() < 0.6:
            labels.append((i, 1, toxic if rng.random() < 0.98 else 1 - toxic))
        rows[-1] += (f"s{i % 3}",)
        yield_toxic[i] = toxic
    return rows, labels


yield_toxic: dict[int, int] = {}


def test_held_out_accuracy(spark, docs_of):
    rows, labels = corpus()
    found = tx.score_documents(docs_of(rows), spark.createDataFrame(labels, LABELS)).collect()
    held = [r for r in found if r.held_out]
    assert {r.row.doc_id for r in held} == {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    right = [r.predicted == yield_toxic[r.row.doc_id] for r in held]
    assert np.mean(right) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)


def test_only_the_text_decides(spark, docs_of):
    rows, labels = corpus(400)
    table = spark.createDataFrame(labels, LABELS)
    extra = [(10_000 + k, rows[5][1], None) for k in range(3)]
    found = {r.row.doc_id: r.score for r in tx.score_documents(docs_of(rows + extra), table).collect()}
    assert len({found[5], *(found[10_000 + k] for k in range(3))}) == 1


def test_held_out_labels_change_nothing(spark, docs_of):
    rows, labels = corpus(400)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    scores = [
        sorted((r.row.doc_id, r.score) for r in tx.score_documents(docs_of(rows), spark.createDataFrame(x, LABELS)).collect())
        for x in (labels, turned)
    ]
    assert scores[0] == scores[1]


def test_label_model_finds_the_class_through_noisy_labels():
    rng = np.random.default_rng(3)
    y = (rng.random(4000) < 0.2).astype(float)
    votes = np.zeros((4000, 12), np.float32)
    for j in range(6):
        votes[:, j] = rng.random(4000) < np.where(y == 1, 0.5, 0.01)
    for j in range(6, 12):  # copies of one voter
        votes[:, j] = votes[:, 0]
    gold = np.where(rng.random(4000) < 0.9, y, 1 - y)
    posterior = tx.label_model(votes, gold, np.ones(4000), 50)

    def area(score):
        order = np.argsort(np.argsort(score + 1e-9 * rng.random(4000)))
        positive = y == 1
        n = positive.sum()
        return (order[positive].sum() - n * (n - 1) / 2) / (n * (4000 - n))

    assert area(posterior) > area(gold) + 0.03


def test_copied_voters_share_their_weight():
    rng = np.random.default_rng(4)
    y = (rng.random(3000) < 0.3).astype(float)
    one = (rng.random(3000) < np.where(y == 1, 0.6, 0.1)).astype(np.float32)[:, None]
    gold = np.where(rng.random(3000) < 0.8, y, 1 - y)
    single = tx.label_model(one, gold, np.ones(3000), 40)
    many = tx.label_model(np.repeat(one, 20, axis=1), gold, np.ones(3000), 40)
    assert np.abs(single - many).max() < 0.1


def test_stage_drops_toxic_rows_and_keeps_columns(spark, docs_of):
    rows, labels = corpus(600)
    docs = docs_of(rows, extra="1 as score").withColumn("predicted", F.lit("k"))
    kept = tx.drop_toxic(docs, spark.createDataFrame(labels, LABELS))
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    wrong = [i for i, *_ in rows if (i in ids) == bool(yield_toxic[i])]
    assert len(wrong) < 0.02 * len(rows)


@pytest.mark.parametrize("labels", [[], [(1, 0, 0), (2, 0, 0), (None, None, 1)], [(1, None, None)]])
def test_without_both_classes_nothing_is_toxic(spark, docs_of, labels):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "long " * 50_000), (3, "long " * 50_000)]
    found = tx.score_documents(docs_of(rows), spark.createDataFrame(labels, LABELS)).collect()
    assert len(found) == 5 and {r.predicted for r in found} == {0}
    assert tx.score_documents(docs_of([]), spark.createDataFrame(labels, LABELS)).count() == 0


def test_repeated_labels_count_by_majority(spark, docs_of):
    ids = [i for i in range(1, 40) if zlib.crc32(str(i).encode()) % 5][:3]
    labels = [(ids[0], 0, 1), (ids[0], 0, 1), (ids[0], 0, 0), (ids[1], 0, 0), (ids[2], 0, None)]
    docs = docs_of([(i, f"t{i}") for i in ids] * 2)
    sample = tx.labelled(docs, spark.createDataFrame(labels, LABELS), tx.Params()).collect()
    assert sorted((r._text, r._y) for r in sample) == sorted([(f"t{ids[0]}", 1), (f"t{ids[1]}", 0)] * 2)


def test_the_sample_is_bounded(spark, docs_of):
    rows, labels = corpus(300)
    sample = tx.labelled(docs_of(rows), spark.createDataFrame(labels, LABELS), tx.Params(sample_rows=20))
    assert sample.count() == 20
