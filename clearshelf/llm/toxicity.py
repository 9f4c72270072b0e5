"""Toxicity by weak supervision: a generative label model over many lexicon and pattern voters, and
a linear classifier trained on its posterior labels.

Voters are mined from labelled training rows: lexicon voters fire on a word, pattern voters where
words with a stem reach a share of the text. The label model sees who fires together.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearshelf.llm.common import alnum_words, arrow_map, as_row, crc32_text, utf8
from clearshelf.sources.tables import stage


@dataclass(frozen=True)
class Params:
    #: Labelled rows the model is fitted on, those of the smallest id hash; a bound on driver memory.
    sample_rows: int = 20_000
    #: Words and stems of toxic rows that are looked at, by support; a bound on what the driver gets.
    candidates: int = 50_000
    #: Lexicon voters, and pattern voters, at most.
    voters: int = 256
    #: Lengths of stems in bytes.
    stems: tuple[int, ...] = (4, 5, 6, 7, 8)
    #: A pattern voter fires if words with its stem reach such a share of a text; 0: any word.
    shares: tuple[float, ...] = (0.0, 0.005, 0.01)
    least_support: int = 4
    #: Lower end of a voter's log odds; a voter also fires in more toxic rows than others.
    least_odds: float = 1.5
    em_rounds: int = 30
    fit_rounds: int = 25
    l2: float = 1e-3
    hold_out: int = 5


@dataclass
class Model:
    """Voters with their weights; a score needs nothing else."""

    words: dict[bytes, int] = field(default_factory=dict)
    #: stem: (least share, index of the voter), ...
    stems: dict[bytes, list[tuple[float, int]]] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -math.log(99.0)

    def __post_init__(self) -> None:
        self.lengths = tuple(sorted({len(x) for x in self.stems}))
        self.heads = {x[: self.lengths[0]] for x in self.stems} if self.stems else set()
        self.voters = len(self.words) + sum(map(len, self.stems.values()))

    def fired(self, words: list[bytes]) -> tuple[list[int], float]:
        """The voters that fire on a text, and the share of its words that made any fire."""
        counts = Counter(words)
        hit = counts.keys() & self.words.keys()
        found = [self.words[w] for w in hit]
        touched = set(hit)
        if self.stems:
            first, totals = self.lengths[0], Counter()
            for w in counts:
                if w[:first] in self.heads:
                    for n in self.lengths:
                        if len(w) > n and w[:n] in self.stems:
                            totals[w[:n]] += counts[w]
                            touched.add(w)
            for stem, n in totals.items():
                found += [i for share, i in self.stems[stem] if n >= share * len(words)]
        return found, sum(counts[w] for w in touched) / len(words) if words else 0.0

    def score(self, words: list[bytes]) -> float:
        """Probability that a text is toxic."""
        z = self.bias
        if len(self.weights):
            index, values = features(*self.fired(words), self.voters)
            z += float(self.weights[index] @ values)
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


#: Counts a mining task holds before it hands them on.
_HELD = 100_000
#: Features after those of the voters: did any fire, the log of how many, the share of words.
MORE = 3


def features(fired: list[int], share: float, voters: int) -> tuple[np.ndarray, np.ndarray]:
    """Sparse features of a text, index and value."""
    index = np.array([*fired, voters, voters + 1, voters + 2], np.int64)
    values = np.ones(len(index))
    values[-3:] = float(bool(fired)), math.log1p(len(fired)), min(100 * share, 5.0)
    return index, values


def voices(words: list[bytes], params: Params) -> set[bytes]:
    """All that could fire on a text: ``w`` and a word, or the number of a share and a stem."""
    counts = Counter(words)
    found = {b"w" + w for w in counts}
    totals: Counter = Counter()
    for n in params.stems:
        for w, k in counts.items():
            if len(w) > n:
                totals[w[:n]] += k
    for level, share in enumerate(params.shares):
        least = share * len(words)
        found |= {b"%d" % level + stem for stem, k in totals.items() if k >= least}
    return found


def labelled(docs: DataFrame, labels: DataFrame, params: Params) -> DataFrame:
    """(``_text``, ``_y``) of the bounded sample: documents with a label that are not held out.

    Several labels of an id count by majority, half is toxic. Rows without an id or a label are out.
    """
    votes = (
        labels.where(F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").alias("_label_id"))
        .agg((F.avg("toxic") >= 0.5).cast("int").alias("_y"))
    )
    rows = docs.select(
        F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("_text")
    ).where(F.col("_id").isNotNull() & (crc32_text(F.col("_id")) % params.hold_out != 0))
    votes = votes.where(crc32_text(F.col("_label_id")) % params.hold_out != 0)
    first = votes.orderBy(F.xxhash64("_label_id"), "_label_id").limit(params.sample_rows)
    return rows.join(F.broadcast(first), rows["_id"] == first["_label_id"]).select("_text", "_y")


def _counted(rows: DataFrame, params: Params, among: set[bytes] | None) -> DataFrame:
    """(``voice``, ``n``): rows with each, added up in every task before the shuffle."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            arrays = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["voice", "n"])

        for batch in batches:
            for text in utf8(batch, "_text"):
                found = voices(alnum_words(text), params)
                counts.update(found if among is None else found & among)
                if len(counts) > _HELD:
                    yield flushed()
        yield flushed()

    parts = arrow_map(rows.select("_text"), counted, "voice binary, n long")
    return parts.groupBy("voice").agg(F.sum("n").alias("n"))


def mine_voters(sample: DataFrame, params: Params) -> Model:
    """A model without weights: the words and stems that toxic rows have far more often than others.

    Toxic rows propose the candidates, the other rows count only those. A voter's standing is the
    lower end of its log odds times the root of its support. A longer stem that fires as often as a
    chosen shorter one says nothing new.
    """
    sizes = {r["_y"]: r["n"] for r in sample.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(1) or not sizes.get(0):
        return Model()
    toxic = _counted(sample.where("_y = 1"), params, None).where(F.col("n") >= params.least_support)
    top = toxic.orderBy(F.col("n").desc(), "voice").limit(params.candidates).collect()
    first = {bytes(r["voice"]): r["n"] for r in top}
    other = _counted(sample.where("_y = 0"), params, set(first))
    second = {bytes(r["voice"]): r["n"] for r in other.collect()}
    ranked = []
    for name, n in first.items():
        k = second.get(name, 0)
        odds = math.log((n + 0.5) / (sizes[1] + 1)) - math.log((k + 0.5) / (sizes[0] + 1))
        low = odds - 1.96 * math.sqrt(1 / (n + 0.5) + 1 / (k + 0.5))
        if low > params.least_odds and n > k:
            ranked.append((-low * math.sqrt(n), len(name), name))
    ranked.sort()
    words = [x[1:] for _, _, x in ranked if x[:1] == b"w"][: params.voters]
    model = Model(words={w: i for i, w in enumerate(words)})
    chosen: dict[bytes, list[bytes]] = {}
    for _, _, x in ranked:
        level, stem = x[:1], x[1:]
        if level == b"w" or model.voters - len(words) >= params.voters:
            continue
        same = chosen.setdefault(level, [])
        if any((stem.startswith(s) or s.startswith(stem)) and first[level + s] == first[x] for s in same):
            continue
        same.append(stem)
        model.stems.setdefault(stem, []).append((params.shares[int(level)], model.voters))
        model.voters += 1
    model.__post_init__()
    return model


def label_model(fired: np.ndarray, gold: np.ndarray, rows: np.ndarray, rounds: int) -> np.ndarray:
    """Posterior probability of the toxic class for each line of a 0/1 matrix of fired voters, which
    stands for ``rows`` equal rows.

    A voter that does not fire abstains; one more voter fires where all others abstain, and the
    human label ``gold`` counts as two, one for each class. Every voter fires at a rate of its own in
    either class. Rates and class balance come from expectation maximisation that starts at the
    human labels. Voters that fire together within a class share their weight: each is divided by
    one plus the sum of its correlations with the others, estimated in every round given the
    posterior. Human labels depend on nothing but the class.
    """
    silent = 1 - fired.any(axis=1, keepdims=True)
    votes = np.concatenate([fired, silent], axis=1).astype(np.float32)
    human = np.stack([gold, 1 - gold], axis=1).astype(np.float64)
    n, m = rows.sum(), votes.shape[1]
    posterior = np.where(gold > 0.5, 0.95, 0.02)
    for _ in range(rounds):
        balance = np.clip((rows @ posterior) / n, 1e-4, 1 - 1e-4)
        odds, human_odds, scatter = np.zeros(m), np.zeros(2), np.zeros((m, m))
        for sign, weight in ((-1, rows * (1 - posterior)), (1, rows * posterior)):
            total = weight.sum()
            rate = (weight @ votes + 0.5) / (total + 1)
            odds += sign * np.log(rate)
            human_odds += sign * np.log((weight @ human + 0.5) / (total + 1))
            # votes are 0 or 1: the covariance comes from how often two fire together
            together = ((votes * weight[:, None].astype(np.float32)).T @ votes).astype(np.float64)
            mean = np.diag(together) / max(total, 1e-9)
            cov = together - total * np.outer(mean, mean)
            deviation = np.sqrt(np.clip(np.diag(cov), 1e-9, None))
            scatter += cov / np.outer(deviation, deviation) * total / n
        correlation = np.clip(scatter, 0, 1)
        np.fill_diagonal(correlation, 0)
        correlation[correlation < 0.1] = 0
        share = 1 / (1 + correlation.sum(axis=1))
        z = math.log(balance / (1 - balance)) + votes @ (odds * share) + human @ human_odds
        updated = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        if np.abs(updated - posterior).max() < 1e-3:
            return updated
        posterior = updated
    return posterior


def fit_linear(
    x: np.ndarray, posterior: np.ndarray, rows: np.ndarray, params: Params
) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on posterior labels, by Newton's method."""
    full = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1).astype(np.float64)
    weight = rows / rows.sum()
    w = np.zeros(full.shape[1])
    penalty = np.full(len(w), params.l2)
    penalty[-1] = 1e-9
    for _ in range(params.fit_rounds):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        gradient = full.T @ (weight * (p - posterior)) + penalty * w
        curve = weight * np.clip(p * (1 - p), 1e-6, None)
        hessian = (full * curve[:, None]).T @ full + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> Model:
    """The fitted model. Without labels of both classes every text gets the score of the bias."""
    sample = stage(labelled(docs, labels, params), "labelled")
    model = mine_voters(sample, params)
    if not model.voters:
        return model

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.fired(alnum_words(t)) for t in utf8(batch, "_text")]
            arrays = [
                pa.array([sorted(x) for x, _ in found], pa.list_(pa.int32())),
                pa.array([round(x, 3) for _, x in found], pa.float64()),
                batch.column(1),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["fired", "share", "_y"])

    # at most sample_rows rows of at most 2 x voters numbers, and equal ones as one
    votes = arrow_map(sample, voted, "fired array<int>, share double, _y int")
    equal = votes.groupBy("fired", "share", "_y").agg(F.count(F.lit(1)).alias("n"))
    lines = equal.orderBy("fired", "share", "_y").collect()
    gold = np.array([r["_y"] for r in lines], np.float64)
    rows = np.array([r["n"] for r in lines], np.float64)
    x = np.zeros((len(lines), model.voters + MORE), np.float32)
    for i, r in enumerate(lines):
        index, values = features(r["fired"], r["share"], model.voters)
        x[i, index] = values
    posterior = label_model(x[:, : model.voters], gold, rows, params.em_rounds)
    model.weights, model.bias = fit_linear(x, posterior, rows, params)
    return model


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (last column ``_text``) with the text replaced by ``_score``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = [model.score(alnum_words(t)) for t in utf8(batch, "_text")]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            names = [*batch.schema.names[:-1], "_score"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(scores, pa.float64())], names=names)

    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("_score", T.DoubleType())])
    return arrow_map(rows, apply, schema)


def score_documents(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """(``row``, ``held_out``, ``score``, ``predicted``) of every document.

    ``row`` holds all columns of ``docs``. Held out are ids whose crc32 as text is divisible by
    ``hold_out``; a null id counts as an empty text, and its row has no label. Null and empty texts
    fire no voter and get the score of the bias. Repeated rows get equal scores; an empty table gives no rows.
    """
    model = fit(docs, labels, params)
    rows = as_row(docs).select("row", F.col("row.text").alias("_text"))
    held_out = crc32_text(F.col("row.doc_id")) % params.hold_out == 0
    return scored(rows, model).select(
        "row",
        held_out.alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """``docs`` without the documents predicted toxic."""
    return score_documents(docs, labels, params).where("predicted = 0").select("row.*")
