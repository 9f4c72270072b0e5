"""Closed syncmers against a plain implementation, edited texts, order of documents."""

import random

from pyspark.sql import functions as F

from clearshelf.llm import syncmers


def words(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice("abcdefghij") + str(rng.randrange(500)) for _ in range(n))


def plain_positions(spark, text):
    """Positions by the definition, with Spark's own hash of each pair of words."""
    split = text.split()
    df = spark.createDataFrame(list(zip(range(len(split) - 1), split, split[1:])), "i int, a string, b string")
    pairs = df.select("i", F.xxhash64(F.xxhash64("a"), F.xxhash64("b")).alias("h")).collect()
    h = [r.h for r in sorted(pairs)]
    return [i for i in range(len(split) - 4) if min(h[i : i + 4]) in (h[i], h[i + 3])]


def test_positions_follow_the_definition(spark, docs_of):
    text = words(300, 1)
    found = [r.position for r in syncmers.anchors_table(docs_of([(1, text)])).collect()]
    assert found == plain_positions(spark, text)


def test_anchors_do_not_depend_on_the_context(spark, docs_of):
    passage = words(60, 2)
    docs = docs_of([(1, passage), (2, words(40, 3) + "  " + passage + "\n" + words(9, 4))])
    table = syncmers.anchors_table(docs).collect()
    alone = {r.hash: r.position for r in table if r.id == 1}
    inside = {r.hash: r.position for r in table if r.id == 2}
    assert alone.keys() <= inside.keys()
    assert {inside[h] - p for h, p in alone.items()} == {40}


def test_edited_texts_and_likeness(spark, docs_of):
    rows = [(30, "abcdef"), (20, None), (10, "wxyz1"), (None, "last é text"), (5, words(400, 5)), (4, words(400, 6))]
    found = {r.row.doc_id: r for r in syncmers.fingerprints(docs_of(rows)).collect()}
    assert found[30].edited == "abc" and found[30].n_chars == 6
    assert found[20].edited == "" and found[20].fingerprint == ""
    assert found[10].edited == "wxy" + rows[4][1][:2]
    assert found[None].edited == "last é" + "abcde"
    five, four = rows[4][1], rows[5][1]
    assert found[5].edited == five[: len(five) - len(five) // 2] + four[: len(five) // 2]
    assert found[5].near_edited > 0.15 and found[5].near_next == 0.0
    assert found[20].near_edited == 1.0


def test_order_across_many_buckets(spark, docs_of, monkeypatch):
    monkeypatch.setattr(syncmers, "_ROWS_IN_BUCKET", 3)
    rng = random.Random(7)
    ids = rng.sample(range(10_000), 150) + [10**12, -5]
    texts = {i: words(rng.randrange(1, 9), i) for i in ids}
    order = sorted(ids, reverse=True)
    found = {r.row.doc_id: r for r in syncmers.fingerprints(docs_of(list(texts.items()))).collect()}
    for i, following in zip(order, [*order[1:], order[0]]):
        t, half = texts[i], len(texts[i]) // 2
        assert found[i].edited == t[: len(t) - half] + texts[following][:half]


def test_equal_texts_ties_and_repeated_rows(spark, docs_of):
    docs = docs_of([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (3, "x")], extra="doc_id as _text")
    found = syncmers.fingerprints(docs).collect()
    assert len(found) == 4
    assert len({r.fingerprint for r in found if r.row.text.startswith("a")}) == 1
    assert next(r for r in found if r.row.doc_id == 3).fingerprint != ""


def test_empty_table_and_single_document(spark, docs_of):
    assert syncmers.fingerprints(docs_of([])).count() == 0
    assert syncmers.fingerprints(docs_of([(1, "abcd")])).first().edited == "abab"


def test_no_python_in_the_plan(spark, docs_of):
    plan = syncmers.fingerprints(docs_of([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_texts_of_five_and_six_words_have_an_anchor(spark, docs_of):
    texts = {n * 100 + i: words(n, n * 100 + i) for n in (5, 6) for i in range(40)}
    found = {}
    for r in syncmers.anchors_table(docs_of(list(texts.items()))).collect():
        found.setdefault(r.id, []).append((r.position, r.hash))
    assert found.keys() == texts.keys()
    assert len({tuple(sorted(a)) for a in found.values()}) == len(texts)
    rows = {r.row.doc_id: r for r in syncmers.fingerprints(docs_of([*texts.items(), (1, "")])).collect()}
    assert all(rows[i].fingerprint != "" for i in texts) and rows[1].fingerprint == ""
    assert all(rows[i].near_next == 0.0 for i in texts)


def test_fingerprint_and_likeness_over_all_anchors_of_long_texts(spark, docs_of):
    base = words(10_000, 11).split()
    changed = [*base]
    for at in (10, 5_000, 9_990):
        changed[at] = "altered"
    passage = words(60, 12).split()
    left, right = words(10_000, 13).split(), words(10_000, 14).split()
    left[4_000:4_060], right[7_000:7_060] = passage, passage
    texts = {9: " ".join(base), 8: " ".join(changed), 7: " ".join(left), 6: " ".join(right), 5: "x" * 300_000}
    docs = docs_of(list(texts.items()))
    sets, order = {}, {}
    for r in syncmers.anchors_table(docs).collect():
        sets.setdefault(r.id, set()).add(r.hash)
        order.setdefault(r.id, []).append((r.position, r.hash))
    rows = {r.row.doc_id: r for r in syncmers.fingerprints(docs).collect()}
    edits = docs_of([(i, rows[i].edited) for i in texts])
    edited = {}
    for r in syncmers.anchors_table(edits).collect():
        edited.setdefault(r.id, set()).add(r.hash)
    for i, following in ((9, 8), (8, 7), (7, 6), (6, 5), (5, 9)):
        assert rows[i].near_next == len(sets[i] & sets[following]) / len(sets[i] | sets[following])
        assert rows[i].near_edited == len(sets[i] & edited[i]) / len(sets[i] | edited[i])
        assert rows[i].fingerprint == "".join(f"{h:08x}" for _, h in sorted(order[i]))
    assert rows[9].fingerprint != rows[8].fingerprint and 0.99 < rows[9].near_next < 1
    assert rows[7].near_next > 0
