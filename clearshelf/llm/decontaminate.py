"""Benchmark decontamination with a generalised suffix automaton over the words of test items."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearshelf.llm.common import alnum_words, arrow_map, utf8

WINDOW = 13
#: Words of items in one automaton. A larger benchmark goes through several, one after the other.
MOST_WORDS = 1_000_000
#: A document is contaminated if hit words are at least one in this many.
COVERAGE = 20


class Automaton:
    """Generalised suffix automaton of word sequences, with the items of every window.

    ``feed`` walks a word sequence: at each word the state stands for the longest suffix that
    occurs in some item, and ``length`` is its number of words.
    """

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        self.shortest = min([window, *(len(w) for _, w in items if w)])
        paths = []
        for item, words in items:
            ids = [self.words.setdefault(w, len(self.words)) for w in words]
            last = 0
            for word in ids:
                last = self._extend(last, word)
            if ids:
                paths.append((item, ids))
        self.found: dict[int, dict[int, list]] = {}
        for item, ids in paths:
            self._mark(item, ids)

    def _clone(self, p: int, word: int, q: int) -> int:
        clone = len(self.len)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.len.append(self.len[p] + 1)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: int) -> int:
        q = self.next[last].get(word)
        if q is not None:  # the sequence so far is in another item
            return q if self.len[q] == self.len[last] + 1 else self._clone(last, word, q)
        new = len(self.len)
        self.next.append({})
        self.link.append(0)
        self.len.append(self.len[last] + 1)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.len[q] == self.len[p] + 1 else self._clone(p, word, q)
        return new

    def _mark(self, item: object, ids: list[int]) -> None:
        """Note the item at the state of each of its windows, by window length."""
        size = min(self.window, len(ids))
        state = 0
        for at, word in enumerate(ids):
            state = self.next[state][word]
            if at + 1 >= size:
                held = state
                while self.len[self.link[held]] >= size:
                    held = self.link[held]
                items = self.found.setdefault(held, {}).setdefault(size, [])
                if not items or items[-1] != item:
                    items.append(item)

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Merged spans (start, end) of the words inside windows, and the items of these windows.

        A word unknown to all items resets the walk, so only runs of known words that are as long
        as the shortest window are walked.
        """
        if len(words) < self.shortest:
            return [], set()
        ids = np.fromiter((self.words.get(w, -1) for w in words), np.int32, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (ids >= 0).view(np.int8), [0]))))
        spans: list[tuple[int, int]] = []
        items: set = set()
        for start, end in edges.reshape(-1, 2):
            if end - start >= self.shortest:
                self._walk(ids[start:end].tolist(), int(start), spans, items)
        return spans, items

    def _walk(self, ids: list[int], start: int, spans: list, items: set) -> None:
        state = length = 0
        for at, word in enumerate(ids, start + 1):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.len[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            if length < self.shortest:
                continue
            held = state
            while held:
                for size, own in self.found.get(held, {}).items():
                    if size <= length:
                        items.update(own)
                        if spans and at - size <= spans[-1][1]:
                            low = at - size
                            while spans and low <= spans[-1][1]:
                                low = min(low, spans.pop()[0])
                            spans.append((low, at))
                        else:
                            spans.append((at - size, at))
                held = self.link[held]


def automata(
    benchmark: DataFrame, *, id_col: str = "item_id", text_col: str = "text",
    window: int = WINDOW, most_words: int = MOST_WORDS,
) -> Iterator[Automaton]:
    """Automata of at most ``most_words`` words (or one item) each over all items.

    Rows come to the driver one block at a time. Equal rows count once; items without words have no
    window; a null id is an item named null.
    """
    items, held = [], 0
    rows = benchmark.select(F.col(id_col).alias("i"), F.col(text_col).cast("binary").alias("t"))
    for row in rows.distinct().toLocalIterator():
        words = alnum_words(bytes(row["t"]) if row["t"] is not None else None)
        if items and held + len(words) > most_words:
            yield Automaton(items, window)
            items, held = [], 0
        items.append((row["i"], words))
        held += len(words)
    yield Automaton(items, window)


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", SPANS),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def matched(
    docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text",
    window: int = WINDOW, most_words: int = MOST_WORDS,
) -> DataFrame:
    """``row`` (all columns of ``docs``), ``n_words``, ``spans`` (word positions inside windows,
    merged) and ``items`` (their ids as text).

    A window is ``window`` consecutive words of an item, or a shorter item as a whole. Documents
    stream through the automaton; each automaton after the first is one more pass that adds to the
    spans. Null and empty texts have no words. Repeated rows stay.
    """
    now = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        F.col(text_col).alias("_text"),
        F.lit(None).cast(_FOUND).alias("_found"),
    )
    schema = now.schema
    for automaton in automata(benchmark, window=window, most_words=most_words):
        shared = docs.sparkSession.sparkContext.broadcast(automaton)

        def searched(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            automaton = shared.value
            for batch in batches:
                found = []
                for text, old in zip(utf8(batch, "_text"), batch.column(2).to_pylist()):
                    words = alnum_words(text)
                    spans, items = automaton.hits(words)
                    names = {str(i) for i in items}
                    if old:
                        spans = _merged(spans + [(s["start"], s["end"]) for s in old["spans"]])
                        names |= set(old["items"])
                    found.append(
                        {
                            "n_words": len(words),
                            "spans": [{"start": a, "end": b} for a, b in spans],
                            "items": sorted(names),
                        }
                    )
                arrays = [batch.column(0), batch.column(1), pa.array(found, batch.schema.field(2).type)]
                yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

        now = arrow_map(now, searched, schema)
    return now.select("row", "_found.*")


def n_hit() -> Column:
    return F.aggregate(
        "spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]
    )


def contaminated(coverage: int = COVERAGE):
    """Some word is hit, and hit words are at least one in ``coverage``."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * coverage >= F.col("n_words"))


def report(docs: DataFrame, benchmark: DataFrame, *, coverage: int = COVERAGE, **options) -> DataFrame:
    """``matched`` with ``n_hit``, ``n_items`` and ``contaminated``."""
    found = matched(docs, benchmark, **options).withColumn("n_hit", n_hit())
    return found.withColumns(
        {"n_items": F.size("items").cast("long"), "contaminated": contaminated(coverage)}
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without its contaminated documents; the others stay as they are."""
    return report(docs, benchmark, **options).where(~F.col("contaminated")).select("row.*")


def remove_spans(
    docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text",
    most_length: int = 0, coverage: int = COVERAGE, **options,
) -> DataFrame:
    """``docs`` with matched passages cut out of the text.

    A span goes if it has more than ``most_length`` words, or if hit words reach one in
    ``coverage`` of the document. Separators next to a cut word stay; a null text stays null.
    """
    found = report(docs, benchmark, text_col=text_col, coverage=coverage, **options)
    limit = F.lit(most_length)
    gone = F.filter("spans", lambda s: F.col("contaminated") | (s["end"] - s["start"] > limit))
    rows = found.select("row", F.col(f"row.`{text_col}`").alias("_text"), gone.alias("_gone"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(utf8(batch, "_text"), batch.column(2).to_pylist()):
                texts.append(without_words(text, [(s["start"], s["end"]) for s in spans]))
            arrays = [batch.column(0), pa.array(texts, pa.string()), batch.column(2)]
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    done = arrow_map(rows, cut, rows.schema)
    return done.select(
        *[
            F.col("_text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c)
            for c in docs.columns
        ]
    )


def without_words(text: bytes | None, spans: list[tuple[int, int]]) -> bytes | None:
    """The text without the words at the given positions."""
    if not text or not spans:
        return text
    import re

    gone = {i for a, b in spans for i in range(a, b)}
    words = re.finditer(rb"[0-9A-Za-z\x80-\xff]+", text)
    out, at = [], 0
    for i, word in enumerate(words):
        if i in gone:
            out.append(text[at : word.start()])
            at = word.end()
    return b"".join([*out, text[at:]])
