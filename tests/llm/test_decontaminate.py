"""Decontamination: the automaton against windows listed one by one."""

import random
import re

import pytest
from pyspark.sql import functions as F

from clearshelf.llm import decontaminate as dc
from clearshelf.llm.common import alnum_words

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window=13):
    words = words_of(text)
    hit, found = [False] * len(words), set()
    for item, item_text in items:
        own = words_of(item_text)
        size = min(window, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1):
            if size and tuple(words[i : i + size]) in windows:
                hit[i : i + size] = [True] * size
                found.add(str(item))
    return len(words), sum(hit), sorted(found)


def random_case(seed, letters):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice(letters) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 12, 13, 14, 25]))) for i in range(8)]
    items += [(100, items[-1][1]), (101, None), (None, text(13))]
    docs = []
    for i in range(60):
        body = text(rng.randrange(40))
        if rng.random() < 0.7:
            own = rng.choice(items)[1] or ""
            a = rng.randrange(len(own) + 1)
            body = f"{body} {own[a:] if rng.random() < 0.5 else own}, {text(rng.randrange(10))}"
        docs.append((i, body))
    return docs, items


def benchmark_of(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def check(spark, docs_of, docs, items, **options):
    found = dc.report(docs_of(docs), benchmark_of(spark, items), **options).collect()
    assert len(found) == len(docs)
    for r in found:
        n, hit, ids = brute(r.row.text, items)
        ids = sorted("None" if i is None else i for i in ids)
        assert (r.n_words, r.n_hit, sorted(r["items"])) == (n, hit, ids), r.row.text
        assert r.contaminated == (hit > 0 and 20 * hit >= n)
        assert r.n_items == len(ids)


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force_with_few_letters(spark, docs_of, seed):
    check(spark, docs_of, *random_case(seed, ["a", "b", "C"]))


def test_equals_brute_force_with_many_words_in_several_automata(spark, docs_of):
    docs, items = random_case(9, [f"Wörd{i}" for i in range(40)])
    check(spark, docs_of, docs, items, most_words=30)


def test_words_are_cut_as_stated():
    text = "A1b-É_ö`Z{~}x\x7fy z ſK"
    assert [w.decode() for w in alnum_words(text.encode())] == words_of(text)


def test_nulls_long_texts_repeats_and_empty_tables(spark, docs_of):
    item = " ".join(f"i{k}" for k in range(20))
    docs = [(1, None), (2, ""), (2, ""), (None, item), (3, "x " * 60_000 + item + " y" * 200), (4, item.upper())]
    check(spark, docs_of, docs, [(7, item)])
    check(spark, docs_of, docs, [])
    assert dc.report(docs_of([]), benchmark_of(spark, [(7, item)])).count() == 0


def test_clean_documents_stay_as_they_are(spark, docs_of):
    item = " ".join(f"i{k}" for k in range(20))
    docs = docs_of([(1, item), (2, "x " * 600 + item), (3, "clean"), (4, None)], extra="1 as spans")
    docs = docs.withColumn("items", F.lit("k"))
    kept = dc.drop_contaminated(docs, benchmark_of(spark, [(7, item)]))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]


def test_spans_are_cut_out(spark, docs_of):
    item = " ".join(f"i{k}" for k in range(20))
    docs = docs_of([(1, f"before, {item.upper()}! after"), (2, "x " * 600 + item + " end"), (3, None)])
    cut = {r.doc_id: r.text for r in dc.remove_spans(docs, benchmark_of(spark, [(7, item)]), most_length=50).collect()}
    assert words_of(cut[1]) == ["before", "after"]
    assert item in cut[2] and cut[3] is None
    cut = {r.doc_id: r.text for r in dc.remove_spans(docs, benchmark_of(spark, [(7, item)])).collect()}
    assert item not in cut[2] and cut[2].endswith(" end")
