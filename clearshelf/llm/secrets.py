"""Secret scan with corpus-wide ownership of candidates."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearshelf.llm.common import arrow_map, utf8
from clearshelf.sources.tables import stage

# Kinds in their order, patterns and least lengths.
BASE_KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX_RUN = re.compile(r"[0-9a-f]{32,}")
LEAST = {"assign": 8, "access": 16, "hex": 32}
OPAQUE = re.compile(r"[A-Za-z0-9+/_-]{20,}")
#: The kind of a span the method adds, after the base kinds.
ADDED_KIND = "owned"
#: A value seen in so many sources is a copied example.
COPIED_SOURCES = 3
LEAST_ENTROPY = 3.0


def entropy(value: str) -> float:
    """Bits per character of a value's own letter frequencies."""
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in Counter(value).values()) if n else 0.0


def base_matches(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the base patterns, leftmost without overlap per kind."""
    found = []
    lowered = text.lower()
    if any(w in lowered for w in ("passw", "secret", "token", "api")):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST["assign"]:
                found.append(("assign", m.start(), m.end(), m[2]))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if len(m[0]) >= LEAST["access"]:
                found.append(("access", m.start(), m.end(), m[0]))
    # a maximal run fails or holds as a whole, so looking for long runs finds the same matches
    found += [("hex", m.start(), m.end(), m[0]) for m in HEX_RUN.finditer(text)]
    return found


def opaque_matches(text: str, taken: list[tuple[str, int, int, str]]) -> list[tuple[str, int, int, str]]:
    """Further candidates: long values of mixed letters and digits outside the base matches."""
    found = []
    for m in OPAQUE.finditer(text):
        value = m[0]
        if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
            continue
        if value.count("-") + value.count("/") + value.count("_") > len(value) // 6:
            continue
        if any(m.start() < end and start < m.end() for _, start, end, _ in taken):
            continue
        if entropy(value) >= LEAST_ENTROPY:
            found.append((ADDED_KIND, m.start(), m.end(), value))
    return found


SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("value", T.StringType()),
    ]
)


def candidates(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``row`` (all columns but the text stay with it) and ``found``, the array of candidate spans.

    ``value`` is the SHA-256 of the candidate's secret part, never the secret itself.
    """
    keep = [c for c in docs.columns if c != text_col]
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in keep]).alias("row"), F.col(text_col).alias("_text")
    )
    schema = T.StructType([rows.schema["row"], T.StructField("found", T.ArrayType(SPAN))])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kind = to_arrow_schema(schema).field("found").type
        for batch in batches:
            out = []
            for raw in utf8(batch, "_text"):
                text = raw.decode() if raw else ""
                spans = base_matches(text)
                spans += opaque_matches(text, spans)
                out.append(
                    [
                        {"kind": k, "start": a, "end": b, "value": hashlib.sha256(v.encode()).hexdigest()}
                        for k, a, b, v in spans
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, kind)], names=["row", "found"]
            )

    return arrow_map(rows, scanned, schema)


def ownership(found: DataFrame, *, owner_col: str) -> DataFrame:
    """(``value``, ``n_sources``, ``n_docs``) of every candidate hash.

    ``found`` has ``row`` and ``found`` of ``candidates``; the owner is a column of ``row`` and null
    is an owner of its own. Pairs of value and owner meet first, so a value that a third of all
    documents copy reaches the second aggregate as one row per owner.
    """
    spans = found.select(
        F.col(f"row.`{owner_col}`").cast("string").alias("owner"),
        F.explode(F.array_distinct(F.transform("found", lambda s: s["value"]))).alias("value"),
    )
    pairs = spans.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy("value").agg(
        F.count(F.lit(1)).alias("n_sources"), F.sum("n").alias("n_docs")
    )


def scan(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
    copied_sources: int = COPIED_SOURCES,
) -> DataFrame:
    """Secret spans of every document: id, ``spans``, ``n_copied``, ``n_owned``.

    ``spans`` is an array of (``start``, ``rank``, ``kind``, ``end``, ``copied``) in code points, the
    end exclusive, by start and then by kind as listed. All base matches are spans. A long opaque
    value outside them becomes a span of kind ``owned`` if a single owner has it. ``n_copied`` counts
    spans whose value at least ``copied_sources`` owners have (widely copied examples), ``n_owned``
    those that one owner alone has (live-looking). Null and empty texts have no spans, repeated
    rows stay, an empty table gives no rows.
    """
    narrow = docs.select(
        F.col(id_col).alias("id"), F.col(owner_col).alias("owner"), F.col(text_col).alias("text"),
        F.monotonically_increasing_id().alias("at"),
    )
    found = stage(candidates(narrow), "candidates")
    owners = ownership(found, owner_col="owner")
    spans = found.select(F.col("row.at").alias("at"), F.explode("found").alias("s"))
    known = spans.join(owners, spans["s.value"] == owners["value"])
    kinds = F.array(*[F.lit(k) for k in (*BASE_KINDS, ADDED_KIND)])
    alone, copied = F.col("n_sources") == 1, F.col("n_sources") >= copied_sources
    kept = known.where(F.col("s.kind").isin(*BASE_KINDS) | alone)
    span = F.struct(
        F.col("s.start").alias("start"),
        F.array_position(kinds, F.col("s.kind")).alias("rank"),
        F.col("s.kind").alias("kind"),
        F.col("s.end").alias("end"),
        copied.alias("copied"),
    )
    by_doc = kept.groupBy("at").agg(
        F.sort_array(F.collect_list(span)).alias("spans"),
        F.sum(copied.cast("long")).alias("n_copied"),
        F.sum(alone.cast("long")).alias("n_owned"),
    )
    ids = found.select(F.col("row.id").alias("id"), F.col("row.at").alias("at"))
    joined = ids.join(by_doc, "at", "left")
    empty = F.from_json(F.lit("[]"), by_doc.schema["spans"].dataType)
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce("spans", empty).alias("spans"),
        F.coalesce("n_copied", F.lit(0).cast("long")).alias("n_copied"),
        F.coalesce("n_owned", F.lit(0).cast("long")).alias("n_owned"),
    )
