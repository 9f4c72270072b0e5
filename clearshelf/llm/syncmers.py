"""Document fingerprints from closed syncmers. DataFrame functions only.

Letters are words, so a k-mer is k words in a row. It is a closed syncmer if the smallest hash of
its inner s-mers is that of the first or the last one. The choice looks at the k-mer alone, so a
passage has the same anchors wherever it stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearshelf.llm.common import as_row

K, S = 5, 2
_SEPARATOR = r"[\x20\x09-\x0D]+"
_LOW_BITS = 0xFFFFFFFF
_QUANTILES, _ROWS_IN_BUCKET, _MOST_BUCKETS = 64, 1000, 65536


def with_syncmers(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``: the array of (``position``, ``hash``) of a text's closed syncmers.

    ``position`` is the 0-based word where the k-mer starts, ``hash`` a 32-bit hash of its words.
    Of equal inner hashes every one is smallest. A text of words without a closed syncmer, as any of
    1 to k-1 words, has one anchor, its whole sequence of words; an empty or null text has none.
    """
    words, pairs = f"_{out}_words", f"_{out}_pairs"
    split = F.split(F.coalesce(F.col(text), F.lit("")), _SEPARATOR)
    hashed = df.withColumn(
        words, F.transform(F.filter(split, lambda w: w != ""), lambda w: F.xxhash64(w))
    )
    n, rest = F.size(words), F.greatest(F.size(words) - 1, F.lit(0))
    twos = F.zip_with(F.slice(words, 1, rest), F.slice(words, 2, rest), lambda a, b: F.xxhash64(a, b))
    paired = hashed.withColumn(pairs, twos)
    g = F.col(pairs)
    starts = F.filter(
        F.sequence(F.lit(0), F.greatest(n - K, F.lit(0))),
        lambda i: F.least(g[i], g[i + (K - S)]) <= F.least(*[g[i + j] for j in range(1, K - S)]),
    )

    def anchor(position: Column, value: Column) -> Column:
        low = value.cast("long").bitwiseAND(F.lit(_LOW_BITS).cast("long"))
        return F.struct(position.alias("position"), low.alias("hash"))

    # the pairs 0-1, 2-3 and 3-4 name all five words
    chosen = F.transform(starts, lambda i: anchor(i, F.xxhash64(g[i], g[i + 2], g[i + 3])))
    whole = F.array(anchor(F.lit(0), F.xxhash64(words)))
    none = F.slice(whole, 1, 0)
    some = paired.withColumn(out, F.when(n >= K, chosen).otherwise(none))
    fallback = F.when((F.size(out) == 0) & (n > 0), whole).otherwise(F.col(out))
    return some.withColumn(out, fallback).drop(words, pairs)


def hashes(anchors: str) -> Column:
    """The hashes of all anchors in the order of their positions, repeats included."""
    return F.transform(F.col(anchors), lambda a: a["hash"])


def as_text(values: Column) -> Column:
    """Hashes as hexadecimal text, eight digits an anchor; empty without anchors."""
    return F.array_join(
        F.transform(values, lambda h: F.lpad(F.lower(F.hex(h)), 8, "0")), ""
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of common anchors: of the distinct hashes of both texts together, the part that both
    have. 1 if neither has any, 0 if one has none."""
    both = F.size(F.array_union(a, b))
    shared = F.size(F.array_intersect(a, b))
    return F.when(both == 0, 1.0).otherwise(shared / both).cast("double")


def anchors_table(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id``, ``position``, ``hash``) of every anchor, for matching passages by position."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text"))
    anchored = with_syncmers(rows, "_text", "_anchors")
    # an inner generator puts a filter on its input below the projections, which then finds all
    # anchors anew inside every step of the lambdas: quadratic in the text
    return anchored.select("id", F.inline_outer("_anchors")).where(F.col("position").isNotNull())


def _bucketed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_bucket``, a monotone bucket of ``_id`` with about 1,000 rows.

    Sixty-four quantiles of the ids come from one aggregate; each range is cut into equal widths.
    Null ids are below all others. There are at most 65,536 buckets.
    """
    cuts = [i / _QUANTILES for i in range(1, _QUANTILES)]
    found = rows.agg(
        F.count("_id").alias("n"),
        F.min("_id").alias("low"),
        F.max("_id").alias("high"),
        F.percentile_approx("_id", cuts, 10000).alias("cuts"),
    ).first()
    if not found["n"]:
        return rows.withColumn("_bucket", F.lit(-1).cast("long"))
    bounds = sorted({found["low"], *found["cuts"]}) + [found["high"] + 1]
    parts = max(1, min(_MOST_BUCKETS, found["n"] // _ROWS_IN_BUCKET) // _QUANTILES)
    array = F.array(*[F.lit(b).cast("long") for b in bounds])
    below = rows.withColumn("_at", F.size(F.filter(array, lambda b: b <= F.col("_id"))))
    low, high = array[F.col("_at") - 1], array[F.col("_at")]
    part = F.floor((F.col("_id") - low) * parts / (high - low))
    inside = (F.col("_at") - 1) * parts + F.least(part, F.lit(parts - 1))
    bucket = F.when(F.col("_id").isNull(), -1).otherwise(inside).cast("long")
    return below.withColumn("_bucket", bucket).drop("_at")


def with_next(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``rows`` with ``_next``: a struct of ``columns`` of the row that follows by descending
    ``_id`` (ties by ``_tie``); the first row follows the last one.

    Rows meet in buckets of the id. The first row of each bucket, one row in a thousand, is joined
    to the last row of the bucket before it, so the long columns are shuffled once.
    """
    buckets = _bucketed(rows)
    window = Window.partitionBy("_bucket").orderBy(F.col("_id").desc_nulls_last(), "_tie")
    payload = F.struct(*columns)
    inside = buckets.withColumns(
        {"_next": F.lead(payload).over(window), "_place": F.row_number().over(window)}
    )
    # the first row of a bucket: its id, then its tie, found without moving long columns
    first = F.max_by(F.struct("_id", "_tie"), F.struct(F.coalesce("_id", F.lit(0)), -F.col("_tie")))
    heads = buckets.groupBy("_bucket").agg(first.alias("_head"))
    down = Window.orderBy(F.col("_bucket").desc())
    names = Window.partitionBy()
    before = F.coalesce(F.lag("_bucket").over(down), F.min("_bucket").over(names))
    links = heads.select(
        F.col("_bucket").alias("_own"),
        F.col("_head._id").alias("_head_id"),
        F.col("_head._tie").alias("_head_tie"),
        before.alias("_previous"),
    )
    # at most 65,537 narrow rows
    bridge = (
        buckets.join(
            F.broadcast(links),
            (F.col("_bucket") == F.col("_own"))
            & F.col("_id").eqNullSafe(F.col("_head_id"))
            & (F.col("_tie") == F.col("_head_tie")),
        )
        .select("_previous", payload.alias("_across"))
        .dropDuplicates(["_previous"])
    )
    joined = inside.join(
        bridge,
        (F.col("_bucket") == F.col("_previous")) & F.col("_next").isNull(),
        "left",
    )
    return joined.select(
        *rows.columns, F.coalesce("_next", "_across").alias("_next")
    )


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every text and of its edited text, and how alike they are.

    One row per document: ``row`` (all input columns), ``n_chars``, ``edited``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``. A fingerprint has all anchors of a text
    in the order of their positions, and likeness counts all of both, wherever they stand. In the
    edited text the last floor(n_chars/2) code points give way to as many of the next document, by
    descending id; the first document follows the last. A null text counts as empty. Null ids come
    last, equal ids in the order of the text's hash; a single document is followed by itself. An
    empty table gives no rows.

    Only texts are shuffled; the anchors of the next text are found again where it meets the other.
    """
    text = F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))
    rows = as_row(docs).select(
        "row",
        F.col(f"row.`{id_col}`").cast("long").alias("_id"),
        text.alias("_text"),
        F.crc32(text.cast("binary")).alias("_tie"),
    )
    followed = with_next(rows, ("_text",))
    n = F.char_length("_text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left(F.col("_text"), n - half), F.left(F.col("_next._text"), half))
    marked = followed.select(
        "row", n.cast("long").alias("_n"), "_text", edited.alias("_edited"), F.col("_next._text").alias("_following")
    )
    for column, out in (("_text", "_own"), ("_following", "_other"), ("_edited", "_changed")):
        marked = with_syncmers(marked, column, "_anchors").withColumn(out, hashes("_anchors")).drop("_anchors")
    mine, changed = F.col("_own"), F.col("_changed")
    return marked.select(
        "row",
        F.col("_n").alias("n_chars"),
        F.col("_edited").alias("edited"),
        as_text(mine).alias("fingerprint"),
        as_text(changed).alias("edited_fingerprint"),
        likeness(mine, changed).alias("near_edited"),
        likeness(mine, F.col("_other")).alias("near_next"),
    )
