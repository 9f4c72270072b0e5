"""Interpolated modified Kneser-Ney bigram model, counted in Spark and kept as sorted hash arrays.

Training words and pairs are counted per task, dealt by the range of their hash and merged; each
range becomes one sorted array file in the shared folder. Scoring tasks memory-map these files.
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearshelf.llm.common import arrow_map, crc32_text, spaced_words, utf8
from clearshelf.sources.tables import fresh_path

#: Words held in a task before counts are flushed, and words or pairs wanted in one range.
FLUSH, RANGE = 4_000_000, 6_000_000
HOLD_OUT, HELD = 7, 2
#: The end of a text and the start of one, as hashes that stand apart from words by their prefix.
END = xxhash.xxh64_intdigest(b" end")
_BLOB = "part int, payload binary"


def hashes(text: bytes | None) -> np.ndarray:
    """Hashes of the words of a text and its end. Words hold no white space, so the end is no word."""
    words = spaced_words(text)
    found = np.empty(len(words) + 1, np.uint64)
    if words:
        found[:-1] = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    found[-1] = END
    return found


def local_path(folder: str) -> str:
    """The shared folder as the workers mount it; they map its files into memory."""
    url = urlparse(folder)
    if url.scheme not in ("", "file"):
        raise ValueError(f"memory mapping needs a mounted shared folder, not {url.scheme}")
    return url.path


def _packed(values: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted values and counts, by byte of the differences: high bytes are zero and compress."""
    steps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    planes = steps.view(np.uint8).reshape(-1, 8).T.tobytes()
    return planes + counts.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(payload) // 12
    planes = np.frombuffer(payload, np.uint8, 8 * n).reshape(8, n).T
    steps = np.ascontiguousarray(planes).view(np.uint64).reshape(-1)
    low = np.frombuffer(payload, np.uint8, 4 * n, 8 * n).reshape(4, n).T
    return np.cumsum(steps, dtype=np.uint64), np.ascontiguousarray(low).view(np.uint32).reshape(-1)


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values.sort()
    edges = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return values[edges], np.diff(np.append(edges, len(values))).astype(np.uint32)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sum the counts of equal values over several sorted arrays."""
    values = np.concatenate([p[0] for p in parts])
    counts = np.concatenate([p[1] for p in parts]).astype(np.uint64)
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    edges = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return values[edges], np.add.reduceat(counts, edges)


def _part_of(values: np.ndarray, parts: int) -> np.ndarray:
    """Range of a 64-bit hash, of ``parts`` equal ranges."""
    return ((values >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _dealt(values: np.ndarray, counts: np.ndarray, parts: int) -> Iterator[tuple[int, bytes]]:
    """The sorted values cut at the edges of the ranges."""
    edges = np.searchsorted(_part_of(values, parts), np.arange(parts + 1))
    for part in np.flatnonzero(np.diff(edges)):
        cut = slice(edges[part], edges[part + 1])
        yield int(part), _packed(values[cut], counts[cut])


def _rows(found: Iterator[tuple[int, bytes]]) -> pa.RecordBatch:
    pairs = list(found)
    return pa.RecordBatch.from_arrays(
        [pa.array([p for p, _ in pairs], pa.int32()), pa.array([b for _, b in pairs], pa.binary())],
        names=["part", "payload"],
    )


def _saved(path: str, array: np.ndarray) -> None:
    """Write a file whole or not at all, so that a repeated task does no harm."""
    own = f"{path}.{uuid.uuid4().hex}"
    with open(own, "wb") as f:
        f.write(np.ascontiguousarray(array).data)
    os.replace(own, path)


def _mapped(path: str, kind: type) -> np.ndarray:
    if not os.path.getsize(path):
        return np.zeros(0, kind)
    return np.memmap(path, kind, "r")


def _spread(keys: np.ndarray, parts: int) -> np.ndarray:
    """Part of a pair key, evenly whatever its words: a mixed hash of the key picks the range."""
    mixed = keys ^ (keys >> np.uint64(31))
    mixed = mixed * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed = mixed * np.uint64(0xBF58476D1CE4E5B9)
    return _part_of(mixed ^ (mixed >> np.uint64(32)), parts)


@dataclass(frozen=True)
class Model:
    """What a scoring task needs besides the files: sizes, discounts and totals."""

    folder: str
    parts: int
    starts: tuple[int, ...]  # number of the first word of each part
    n_docs: int
    n_tokens: int
    n_words: int
    n_pairs: int = 0
    discounts: tuple[float, float, float] = (0.5, 0.5, 0.5)
    low_discounts: tuple[float, float, float] = (0.5, 0.5, 0.5)
    low_mass: float = 1.0

    def file(self, kind: str, part: int) -> str:
        return f"{self.folder}/{kind}-{part}"

    @property
    def start_number(self) -> int:
        """The number of the start of a text, after all words."""
        return self.n_words


class Files:
    """The model's arrays, mapped into memory when first asked for."""

    KINDS = {"words": np.uint64, "counts": np.uint64, "pairs": np.uint64, "pair_counts": np.uint32,
             "mass": np.float32, "before": np.uint32}

    def __init__(self, model: Model):
        self.model = model
        self.starts = np.array(model.starts, np.int64)
        self.open: dict[tuple[str, int], np.ndarray] = {}

    def get(self, kind: str, part: int) -> np.ndarray:
        if (kind, part) not in self.open:
            self.open[kind, part] = _mapped(self.model.file(kind, part), self.KINDS[kind])
        return self.open[kind, part]

    def numbers(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of sorted distinct hashes, -1 for unknown words, and training counts."""
        numbers = np.full(len(found), -1, np.int64)
        counts = np.zeros(len(found), np.float64)
        parts = _part_of(found, self.model.parts)
        edges = np.searchsorted(parts, np.arange(self.model.parts + 1))
        for part in np.flatnonzero(np.diff(edges)):
            own = slice(edges[part], edges[part + 1])
            words = self.get("words", part)
            if len(words):
                at = np.minimum(np.searchsorted(words, found[own]), len(words) - 1)
                known = words[at] == found[own]
                numbers[own] = np.where(known, at + self.starts[part], -1)
                counts[own] = np.where(known, self.get("counts", part)[at], 0)
        return numbers, counts

    def by_number(self, kind: str, numbers: np.ndarray) -> np.ndarray:
        """Values of word numbers (not negative) from the files of a kind."""
        out = np.zeros(len(numbers), np.float64)
        parts = np.searchsorted(self.starts, numbers, side="right") - 1
        for part in np.unique(parts):
            own = parts == part
            out[own] = self.get(kind, int(part))[numbers[own] - self.starts[part]]
        return out

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Training counts of pair keys in any order."""
        out = np.zeros(len(keys), np.float64)
        parts = _spread(keys, self.model.parts)
        order = np.lexsort((keys, parts))
        edges = np.searchsorted(parts[order], np.arange(self.model.parts + 1))
        for part in np.flatnonzero(np.diff(edges)):
            own = order[edges[part] : edges[part + 1]]
            pairs = self.get("pairs", part)
            if len(pairs):
                at = np.minimum(np.searchsorted(pairs, keys[own]), len(pairs) - 1)
                out[own] = np.where(pairs[at] == keys[own], self.get("pair_counts", part)[at], 0)
        return out


_FILES: dict[str, Files] = {}


def _files(model: Model) -> Files:
    """One set of mappings per worker process, those of the last model."""
    if model.folder not in _FILES or _FILES[model.folder].model != model:
        _FILES.clear()
        _FILES[model.folder] = Files(model)
    return _FILES[model.folder]


def _pair_keys(numbers: np.ndarray, ends: np.ndarray, model: Model) -> np.ndarray:
    """Keys of every token with the one before it, the start of a text before its first."""
    before = np.empty(len(numbers), np.int64)
    before[1:] = numbers[:-1]
    before[np.concatenate(([0], ends[:-1] + 1))] = model.start_number
    return (before.astype(np.uint64) << np.uint64(32)) | numbers.astype(np.uint64)


def _discounts(counts: np.ndarray) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of types seen once to four times."""
    n1, n2, n3, n4 = (float(x) for x in counts[:4])
    if not n1 or not n2:
        return 0.5, 0.75, 1.0
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.0)
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), found))


def _discounted(counts: np.ndarray, discounts: tuple[float, float, float]) -> np.ndarray:
    """The discount of each count, 0 of an unseen one."""
    table = np.array((0.0, *discounts))
    return table[np.minimum(counts, 3).astype(np.int64)]


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """Blobs of each part; parts come one after the other."""
    part, held = None, []
    for batch in batches:
        for p, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
            if p != part and held:
                yield part, held
                held = []
            part = p
            held.append(payload.as_py())
    if held:
        yield part, held


def _merge(blobs: DataFrame, parts: int, merge, schema: str) -> list:
    """Bring the blobs of each part together, merge and store them; one small row a part."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, payloads in _grouped(batches):
            yield pa.RecordBatch.from_pylist([merge(part, payloads)])

    dealt = blobs.repartition(parts, "part").sortWithinPartitions("part")
    return arrow_map(dealt, merged, schema).collect()


def _token_batches(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[np.ndarray]:
    """Hashes of the tokens of many texts at once; every text ends with ``END``."""
    held, size = [], 0
    for batch in batches:
        for text in utf8(batch, "_text"):
            held.append(hashes(text))
            size += len(held[-1])
            if size >= most:
                yield np.concatenate(held)
                held, size = [], 0
    if held:
        yield np.concatenate(held)


def _count_words(texts: DataFrame, folder: str, parts: int) -> Model:
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens in _token_batches(batches, FLUSH):
            yield _rows(_dealt(*_counted(tokens), parts))

    def merge(part: int, payloads: list[bytes]) -> dict:
        words, counts = _added([_unpacked(p) for p in payloads])
        os.makedirs(folder, exist_ok=True)
        _saved(f"{folder}/words-{part}", words)
        _saved(f"{folder}/counts-{part}", counts)
        ends = counts[words == np.uint64(END)]
        return {"part": part, "n": len(words), "tokens": int(counts.sum()), "docs": int(ends.sum())}

    schema = "part long, n long, tokens long, docs long"
    found = {r["part"]: r for r in _merge(arrow_map(texts, counted, _BLOB), parts, merge, schema)}
    sizes = [found[p]["n"] if p in found else 0 for p in range(parts)]
    starts = np.concatenate(([0], np.cumsum(sizes)))
    if starts[-1] >= 2**32 - 1:
        raise ValueError("pair keys hold word numbers of 32 bits")
    os.makedirs(folder, exist_ok=True)
    for part in set(range(parts)) - set(found):
        for kind in ("words", "counts"):
            _saved(f"{folder}/{kind}-{part}", np.zeros(0, np.uint64))
    return Model(
        folder, parts, tuple(int(x) for x in starts[:-1]),
        n_docs=sum(r["docs"] for r in found.values()),
        n_tokens=sum(r["tokens"] for r in found.values()),
        n_words=int(starts[-1]),
    )


def _count_pairs(texts: DataFrame, model: Model) -> Model:
    folder, parts = model.folder, model.parts

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _files(model)
        for tokens in _token_batches(batches, FLUSH):
            words, at = np.unique(tokens, return_inverse=True)
            numbers = files.numbers(words)[0][at.reshape(-1)]
            ends = np.flatnonzero(tokens == np.uint64(END))
            keys, counts = _counted(_pair_keys(numbers, ends, model))
            own = _spread(keys, parts)
            order = np.argsort(own, kind="stable")  # keys stay sorted inside a part
            edges = np.searchsorted(own[order], np.arange(parts + 1))
            cuts = [(p, order[edges[p] : edges[p + 1]]) for p in np.flatnonzero(np.diff(edges))]
            yield _rows((int(p), _packed(keys[cut], counts[cut])) for p, cut in cuts)

    def merge(part: int, payloads: list[bytes]) -> dict:
        pairs, counts = _added([_unpacked(p) for p in payloads])
        _saved(f"{folder}/pairs-{part}", pairs)
        _saved(f"{folder}/pair_counts-{part}", counts.astype(np.uint32))
        seen = {f"n{k}": int((counts == k).sum()) for k in (1, 2, 3, 4)}
        return {"part": part, "n": len(pairs), **seen}

    schema = "part long, n long, n1 long, n2 long, n3 long, n4 long"
    found = _merge(arrow_map(texts, counted, _BLOB), parts, merge, schema)
    for part in set(range(parts)) - {r["part"] for r in found}:
        _saved(f"{folder}/pairs-{part}", np.zeros(0, np.uint64))
        _saved(f"{folder}/pair_counts-{part}", np.zeros(0, np.uint32))
    seen = np.array([sum(r[f"n{k}"] for r in found) for k in (1, 2, 3, 4)])
    return replace(model, n_pairs=sum(r["n"] for r in found), discounts=_discounts(seen))


def _weigh_words(spark: SparkSession, model: Model) -> Model:
    """Per word: the discount mass of the pairs it begins, and how many different words precede it."""
    folder, parts, discounts = model.folder, model.parts, model.discounts
    starts = np.array(model.starts, np.int64)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair_part in batch.column(0).to_pylist():
                files = Files(model)
                pairs, counts = files.get("pairs", pair_part), files.get("pair_counts", pair_part)
                if not len(pairs):
                    continue
                first, second = pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)
                edges = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
                mass = np.add.reduceat(_discounted(counts, discounts), edges).astype(np.float32)
                found = [(first[edges], mass.view(np.uint32)), _counted(second.copy())]
                for kind, (numbers, values) in enumerate(found):
                    # by pairs of mass and preceding counts: even parts hold masses, odd ones counts
                    part = np.searchsorted(starts, numbers.astype(np.int64), side="right") - 1
                    ends = np.searchsorted(part, np.arange(parts + 1))
                    yield _rows(
                        (int(2 * p + kind), _packed(numbers[ends[p] : ends[p + 1]], values[ends[p] : ends[p + 1]]))
                        for p in np.flatnonzero(np.diff(ends))
                    )

    def merge(part: int, payloads: list[bytes]) -> dict:
        own, counts = part // 2, part % 2
        last = own == last_part
        size = (starts[own + 1] if own + 1 < parts else model.n_words) - starts[own] + last
        total = np.zeros(size, np.uint32 if counts else np.float64)
        for payload in payloads:
            numbers, values = _unpacked(payload)
            at = numbers.astype(np.int64) - starts[own]
            total[at] += values if counts else values.view(np.float32)
        _saved(f"{folder}/{'before' if counts else 'mass'}-{own}", total if counts else total.astype(np.float32))
        seen = {f"n{k}": int((total == k).sum()) if counts else 0 for k in (1, 2, 3, 4)}
        more = int((total > 2).sum()) if counts else 0
        return {"part": part, **seen, "more": more}

    # the start of a text has the number after the last word, in the last part with that number range
    last_part = int(np.searchsorted(starts, model.n_words, side="right") - 1)
    tasks = spark.range(0, parts, 1, parts).select(F.col("id").cast("int").alias("part"))
    schema = "part long, n1 long, n2 long, n3 long, n4 long, more long"
    found = _merge(arrow_map(tasks, sums, _BLOB), 2 * parts, merge, schema)
    done = {r["part"] for r in found}
    for part in set(range(2 * parts)) - done:
        own = part // 2
        size = (starts[own + 1] if own + 1 < parts else model.n_words) - starts[own] + (own == last_part)
        kind, form = ("before", np.uint32) if part % 2 else ("mass", np.float32)
        _saved(f"{folder}/{kind}-{own}", np.zeros(max(0, size), form))
    seen = np.array([sum(r[f"n{k}"] for r in found) for k in (1, 2, 3, 4)])
    low = _discounts(seen)
    more = sum(r["more"] for r in found)
    mass = low[0] * seen[0] + low[1] * seen[1] + low[2] * more
    share = float(mass) / model.n_pairs if model.n_pairs else 1.0
    return replace(model, low_discounts=low, low_mass=share)


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", hold_out: int = HOLD_OUT,
          held: int = HELD) -> Model:
    """Count the training rows (crc32 of the id as text modulo ``hold_out`` is not ``held``).

    Three small jobs: words, pairs, and what pairs say about words. Only sums and one row per range
    of ``RANGE`` tokens come to the driver. Without training rows the model is empty.
    """
    spark = docs.sparkSession
    rows = docs.where(crc32_text(F.col(id_col)) % hold_out != held)
    texts = rows.select(F.col(text_col).alias("_text"))
    size = texts.agg(F.sum(F.octet_length("_text")).alias("n")).first()["n"] or 0
    parts = max(1, math.ceil(size / 6 / RANGE))
    folder = local_path(fresh_path(spark, "ngrams"))
    return _weigh_words(spark, _count_pairs(texts, _count_words(texts, folder, parts)))


def _logs(files: Files, tokens: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of every token: is it known, log10 of its add-one probability, and of the model's."""
    model = files.model
    words, at = np.unique(tokens, return_inverse=True)
    at = at.reshape(-1)
    numbers, counts = files.numbers(words)
    known = numbers >= 0
    base = np.log10((counts + 1) / (model.n_tokens + (model.n_words + 1)))
    low = np.full(len(words), model.low_mass / (model.n_words + 1))
    if model.n_pairs:
        before = files.by_number("before", numbers[known])
        low[known] += (before - _discounted(before, model.low_discounts)).clip(0) / model.n_pairs
    number, p = numbers[at], low[at]
    previous = np.empty(len(at), np.int64)
    previous[1:] = number[:-1]
    opening = np.concatenate(([0], ends[:-1] + 1))
    previous[opening] = model.start_number if model.n_docs else -1
    total = np.empty(len(at))
    total[1:] = counts[at][:-1]
    total[opening] = model.n_docs
    context = previous >= 0
    if context.any():
        contexts, back = np.unique(previous[context], return_inverse=True)
        mass = files.by_number("mass", contexts)[back.reshape(-1)]
        p[context] *= mass / total[context]
        both = context & (number >= 0)
        keys = (previous[both].astype(np.uint64) << np.uint64(32)) | number[both].astype(np.uint64)
        seen = files.pair_counts(keys)
        p[both] += (seen - _discounted(seen, model.discounts)) / total[both]
    return known[at], base[at], np.log10(p)


def score(docs: DataFrame, model: Model, *, text_col: str = "text", most: int = 500_000) -> DataFrame:
    """``row`` (all columns of ``docs``), ``n_tokens``, ``n_known``, ``base_score``, ``score``.

    Texts are looked up many at a time, so that lookups go through the mapped arrays in order.
    """
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), F.col(text_col).alias("_text")
    )
    added = [("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]

    def looked_up(texts: list[bytes | None]) -> list[pa.Array]:
        files = _files(model)
        out: list[list[np.ndarray]] = [[], [], [], []]
        held: list[np.ndarray] = []

        def flush() -> None:
            lengths = np.array([len(h) for h in held])
            ends = np.cumsum(lengths) - 1
            opening = ends - lengths + 1
            known, base, own = _logs(files, np.concatenate(held), ends)
            for to, values in zip(out, (lengths, *(np.add.reduceat(v, opening) for v in (known.astype(np.int64), base, own)))):
                to.append(values)
            held.clear()

        size = 0
        for text in texts:
            held.append(hashes(text))
            size += len(held[-1])
            if size >= most:
                flush()
                size = 0
        if held:
            flush()
        return [pa.array(np.concatenate(v) if v else [], kind) for v, (_, kind) in zip(out, added)]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = looked_up(list(utf8(batch, "_text")))
            yield pa.RecordBatch.from_arrays([batch.column(0), *found], names=["row", *(n for n, _ in added)])

    schema = T.StructType([rows.schema["row"]])
    for name, kind in added:
        schema = schema.add(name, T.LongType() if kind == pa.int64() else T.DoubleType())
    return arrow_map(rows, scored, schema)


def score_documents(docs: DataFrame, *, hold_out: int = HOLD_OUT, held: int = HELD) -> DataFrame:
    """(``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``).

    The model learns from rows that are not held out and scores all. Tokens are words between ASCII
    white space with A-Z lower-cased, then the end of the text; a null text is empty and has the end
    alone. A null id counts as an empty text, repeated rows are counted and scored each, an empty
    table gives no rows. With no training rows the base score is 0 and every token has the
    probability of the unknown word, 1.
    """
    model = train(docs.select("doc_id", "text"), hold_out=hold_out, held=held)
    found = score(docs.select("doc_id", "text"), model)
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        (crc32_text(F.col("row.doc_id")) % hold_out == held).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
