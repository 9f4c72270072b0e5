"""Importance resampling: gains, weights, scores and the draw equal a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from clearshelf.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest):
    words = WORD.findall((text or "").encode().lower().decode())
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), runs


def plain(docs, targets, longest=1, buckets=10_000, least=20, percent=10):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    held = [(i, *features(t, longest)) for i, t in docs]
    s = Counter(bucket(f) for _, _, runs in held for f in runs)
    t = Counter(bucket(f) for x in targets for f in features(x, longest)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
        for b in range(buckets)
    }
    rows = []
    for i, words, runs in held:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in runs)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(runs), weight, weight + noise, words))
    fit = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    n = percent * len(fit) // 100
    found = [(*r[:4], at + 1 if at < n else None) for at, r in enumerate(fit)]
    return sorted([*found, *((*r[:4], None) for r in rows if r[4] < least)], key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "é", "ÉT", "漢字", "x1", "don't", "a\x00b", "Zz"]
    docs = [(i, rng.choice([" ", "  ", ", "]).join(rng.choices(words, k=rng.randint(0, 80)))) for i in range(n)]
    return docs, [" ".join(rng.choices(words[:4], k=30)) for _ in range(10)]


def scored(spark, docs, targets, **params):
    a = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(t,) for t in targets], "text string")
    found = resampling.resampling_scores(a, b, params=resampling.Params(**params))
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("longest", [1, 3])
def test_equals_the_plain_version(spark, longest):
    docs, targets = corpus(1, 400)
    assert scored(spark, docs, targets, words=longest) == plain(docs, targets, longest)


def test_nulls_ties_and_repeated_rows(spark):
    docs = [(5, "beta " * 30)] * 40 + [(None, "beta " * 30)] * 3 + [(i, "beta " * 25) for i in range(30)]
    docs += [(900, None), (901, ""), (None, None), (902, "alpha")]
    targets = ["beta", None, ""]
    assert scored(spark, docs, targets, percent=60) == plain(docs, targets, percent=60)


def test_very_long_text(spark):
    docs = [(1, "word other " * 60_000), (2, "other " * 20)]
    assert scored(spark, docs, ["word"], percent=100) == plain(docs, ["word"], percent=100)


def test_empty_tables(spark):
    assert scored(spark, [], ["a"]) == []
    docs, _ = corpus(2, 30)
    assert scored(spark, docs, []) == plain(docs, [])


def test_windows_join_words_by_one_space():
    text = "a  b-c d"
    found = resampling.splitter().pre_tokenize_str(text)
    assert list(resampling.windows(found, text, 2)) == [b"a", b"b", b"c", b"d", b"a b", b"b c", b"c d"]


def test_ranks_do_not_depend_on_partitions(spark):
    docs, targets = corpus(7, 500)
    a = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(t,) for t in targets], "text string")
    many = resampling.resampling_scores(a.repartition(13), b).collect()
    assert sorted(map(tuple, many), key=str) == plain(docs, targets)


def test_drawn_documents_keep_their_columns(spark):
    docs, targets = corpus(3, 300)
    a = spark.createDataFrame(
        [(i, t, i, "r") for i, t in docs], "doc_id long, text string, rank int, _at string"
    )
    b = spark.createDataFrame([(t,) for t in targets], "text string")
    drawn = resampling.resample(a, b)
    assert drawn.columns == a.columns
    expected = [r[0] for r in plain(docs, targets) if r[4] is not None]
    assert sorted(r.doc_id for r in drawn.collect()) == sorted(expected)
    assert expected
