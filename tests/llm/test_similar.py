"""Near copies against brute-force Jaccard of five-word shingles."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from clearshelf.llm import simhash, similar


def brute_kept(texts):
    """Smallest id of each component of pairs with a similarity of 0.8 or more."""
    sets = {}
    for i, text in texts.items():
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", text.encode().lower().decode()) if x]
        sets[i] = {" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(texts)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            a, b = sets[i], sets[j]
            if find(i) == find(j) or 5 * min(len(a), len(b)) < 4 * max(len(a), len(b)):
                continue
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i for i in ids if find(i) == i}


def family(rng, n, size, edits):
    """Copies of one text, each with up to ``edits`` words changed."""
    base = [f"w{rng.randrange(3000)}" for _ in range(size)]
    out = []
    for _ in range(n):
        words = list(base)
        for at in rng.sample(range(size), rng.randrange(edits + 1)):
            words[at] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def kept(docs_of, texts):
    return {r.doc_id for r in simhash.drop_near_duplicates(docs_of(list(texts.items()))).collect()}


def test_kept_documents_equal_brute_force(spark, docs_of):
    rng = random.Random(3)
    texts = []
    for size, edits in ((9, 1), (40, 2), (120, 4), (400, 16), (400, 30)):
        for _ in range(6):
            texts += family(rng, 5, size, edits)
    texts += ["", " ", "a b", "A b", "a c", "one two three four five", "One two three four five"]
    rng.shuffle(texts)
    by_id = dict(enumerate(texts))
    assert kept(docs_of, by_id) == brute_kept(by_id)


def test_crowded_lists_equal_brute_force(spark, docs_of, monkeypatch):
    monkeypatch.setattr(similar, "PAIRED", 3)
    rng = random.Random(4)
    texts = family(rng, 60, 200, 10) + family(rng, 60, 100, 7)
    rng.shuffle(texts)
    by_id = dict(enumerate(texts))
    assert kept(docs_of, by_id) == brute_kept(by_id)


def test_a_crowd_without_near_copies_makes_no_pairs(spark, docs_of, monkeypatch):
    """Texts that share most of their words, each with a twentieth or more of its words changed."""
    monkeypatch.setattr(similar, "PAIRED", 3)
    rng = random.Random(6)
    texts = [t for t in family(rng, 300, 300, 22) if t.count("x") > 13]
    by_id = dict(enumerate(texts))
    made = []
    unsettled = similar._unsettled

    def counted(members, edges):
        found = unsettled(members, edges)
        made.append((members.select("m").distinct().count(), found.count()))
        return found

    monkeypatch.setattr(similar, "_unsettled", counted)
    assert kept(docs_of, by_id) == brute_kept(by_id) == set(by_id)
    crowd, pairs = made[0]
    assert crowd > 50 and pairs == 0


def test_what_sets_share_bounds_their_similarity(spark):
    """The bound never lies below the similarity, and tells edits in different places apart."""
    rng = random.Random(9)
    texts = family(rng, 40, 150, 6) + family(rng, 20, 60, 3)
    sets = [set(similar.shingles(t.encode()).view("int64").tolist()) for t in texts]
    count = Counter(x for s in sets for x in s)
    rows = []
    for i, s in enumerate(sets):
        alone = {x for x in s if count[x] == 1}
        held = Counter(x % similar.PARTS for x in s - alone)
        rows.append((i, (len(s), len(alone), [held[p] for p in range(similar.PARTS)])))
    df = spark.createDataFrame(rows, "i int, of struct<size:long,alone:long,held:array<int>>")
    x, y = df.select(F.col("i").alias("x"), F.col("of").alias("ox")), df.select(F.col("i").alias("y"), F.col("of").alias("oy"))
    met = x.join(y, F.col("x") < F.col("y")).where(similar._may_be_alike(F.col("ox"), F.col("oy")))
    found = {(r.x, r.y) for r in met.collect()}
    pairs = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))}
    alike = {(i, j) for i, j in pairs if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
    assert alike <= found and len(alike) > 50
    assert len(found - alike) < 0.2 * len(alike)
