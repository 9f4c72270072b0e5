"""Kneser-Ney scores against a plain dictionary model; probabilities sum to one."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest

from clearshelf.llm import kneser_ney as kn


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


class Plain:
    def __init__(self, texts):
        self.counts, pairs = collections.Counter(), collections.Counter()
        for t in texts:
            self.counts.update(tokens(t))
            before = "<start>"
            for w in tokens(t):
                pairs[before, w] += 1
                before = w
        self.pairs = pairs
        self.n, self.v = sum(self.counts.values()), len(self.counts)
        self.before = collections.Counter(w for _, w in pairs)
        self.d, self.low = self.discounts(pairs.values()), self.discounts(self.before.values())
        self.total, self.mass = collections.Counter(), collections.Counter()
        for (h, _), k in pairs.items():
            self.total[h] += k
            self.mass[h] += self.d[min(k, 3)]
        self.rest = sum(self.low[min(k, 3)] for k in self.before.values()) / max(1, len(pairs))

    @staticmethod
    def discounts(counts):
        n = [0] * 5
        for k in counts:
            if k < 5:
                n[k] += 1
        return (0.0, *kn._discounts(np.array(n[1:])))

    def p(self, h, w):
        k = self.before[w]
        low = max(k - self.low[min(k, 3)], 0) / len(self.pairs) + self.rest / (self.v + 1)
        if not self.total[h]:
            return low
        k = self.pairs[h, w]
        return max(k - self.d[min(k, 3)], 0) / self.total[h] + self.mass[h] / self.total[h] * low

    def score(self, text):
        h, total = "<start>", 0.0
        for w in tokens(text):
            total += math.log10(self.p(h, w))
            h = w
        return total

    def base(self, text):
        return sum(math.log10((self.counts[w] + 1) / (self.n + self.v + 1)) for w in tokens(text))


def corpus(n=300, seed=3):
    rng = random.Random(seed)
    words = [f"W{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(words, weights=range(60, 0, -1), k=rng.randrange(30)))) for i in range(n)]
    return [*rows, (n, None), (n + 1, "É unseen\x0bwords"), (n + 2, "x " * 5000), (n + 2, "x"), (None, "w1 w2")]


@pytest.mark.parametrize("words_in_range", [kn.RANGE, 200])
def test_equals_the_plain_model(spark, docs_of, monkeypatch, words_in_range):
    monkeypatch.setattr(kn, "RANGE", words_in_range)
    monkeypatch.setattr(kn, "FLUSH", 500)
    rows = corpus()
    key = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7
    plain = Plain([t for i, t in rows if key(i) != 2])
    found = kn.score_documents(docs_of(rows, extra="1 as row")).collect()
    assert len(found) == len(rows)
    expected = collections.defaultdict(list)
    for i, t in rows:
        expected[i].append((plain.score(t), plain.base(t), len(tokens(t))))
    for r in found:
        assert any(
            r.score == pytest.approx(s, abs=1e-4) and r.base_score == pytest.approx(b, abs=1e-6) and r.n_tokens == n
            for s, b, n in expected[r.doc_id]
        )
    by_id = {r.doc_id: r for r in found}
    assert by_id[300].n_tokens == 1 and by_id[300].n_known == 1
    assert all(r.held_out == (key(r.doc_id) == 2) and r.train_tokens == plain.n for r in found)


def test_probabilities_sum_to_one():
    plain = Plain([t for _, t in corpus()])
    for h in ["<start>", "w0", "w59", "never"]:
        assert sum(plain.p(h, w) for w in [*plain.counts, "unknown"]) == pytest.approx(1.0)


def test_empty_table_and_nothing_to_learn_from(spark, docs_of):
    assert kn.score_documents(docs_of([])).count() == 0
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    found = kn.score_documents(docs_of([(i, "a b") for i in held])).collect()
    assert [(r.n_known, r.train_tokens, r.base_score, r.score) for r in found] == [(0, 0, 0.0, 0.0)] * 3


def test_packed_blobs_come_back():
    values = np.sort(np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64))
    counts = np.arange(1000, dtype=np.uint32)
    back = kn._unpacked(kn._packed(values, counts))
    assert (back[0] == values).all() and (back[1] == counts).all()


def test_mapping_needs_a_mounted_folder():
    assert kn.local_path("file:///a/b") == "/a/b" and kn.local_path("/a") == "/a"
    with pytest.raises(ValueError, match="hdfs"):
        kn.local_path("hdfs://x/a")
