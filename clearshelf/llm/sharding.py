"""Sharding by balanced label propagation: linked documents move to their neighbours' shards as far
as quotas allow, and the counts of all shards end at most one apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearshelf.llm.common import as_row, positions
from clearshelf.sources.tables import stage


def _moves(wanted: dict[tuple[int, int], int], held: list[int], capacity: int) -> dict:
    """How many of the rows that want to go from one shard to another may go.

    Opposite wishes are exchanged in pairs, which leaves sizes as they are. What is left goes
    where there is room, and is tried again while moves out of a shard make room in it.
    """
    allowed = {k: min(n, wanted.get((k[1], k[0]), 0)) for k, n in wanted.items()}
    held, open_ = list(held), True
    while open_:
        open_ = False
        for (i, j), n in sorted(wanted.items(), key=lambda x: (-x[1], x[0])):
            more = min(n - allowed[i, j], capacity - held[j])
            if more > 0:
                allowed[i, j] += more
                held[i] -= more
                held[j] += more
                open_ = True
    return {k: n for k, n in allowed.items() if n}


def _by_shard(labels: DataFrame, shards: int) -> list[int]:
    counted = labels.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()
    found = {r["shard"]: r["n"] for r in counted}
    return [found.get(j, 0) for j in range(shards)]


def _small_table(df: DataFrame, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Driver-side numbers of at most shards x shards rows, so safe to broadcast."""
    return F.broadcast(df.sparkSession.createDataFrame(list(rows), schema))


def _wishes(labels: DataFrame, shards: int, room: Sequence[int] | None) -> DataFrame:
    """Rows that want to leave their shard, and where ``to``.

    A group's home is the shard where most neighbours are. With ``room`` it is a shard with room for
    the rest of the group, else any with room; among these the one with most neighbours. Ties go by
    a hash of group and shard. Where the rest does not fit, rows move only to where more neighbours
    are. One row per group holds at most as many counts as there are shards.
    """
    counts = labels.groupBy("grp", "shard").agg(F.count(F.lit(1)).alias("n"))
    found = counts.groupBy("grp").agg(
        F.map_from_entries(F.collect_list(F.struct("shard", "n"))).alias("held"),
        F.sum("n").alias("size"),
    )

    def at(j: Column) -> Column:
        return F.coalesce(F.try_element_at("held", j), F.lit(0).cast("long"))

    def rank(j: Column) -> Column:
        fits = F.lit(1)
        if room is not None:
            free = F.create_map(*[F.lit(x) for k, n in enumerate(room) for x in (k, max(0, n))])
            fits = F.when(F.col("size") - at(j) <= free[j], 2).when(free[j] > 0, 1).otherwise(0)
        return F.struct(
            fits.alias("fits"), at(j).alias("n"), F.xxhash64("grp", j).alias("tie"), j.alias("shard")
        )

    best = F.array_max(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), rank))
    homes = found.withColumn("best", best)
    here, home = at(F.col("shard")), F.col("best")
    uphill = (home["fits"] == 2) | (here < home["n"])
    if room is None:
        uphill = F.lit(True)
    return labels.join(homes, "grp").where(
        (F.col("shard") != home["shard"]) & (home["fits"] > 0) & uphill
    ).select(
        "key", "grp", "shard", home["shard"].alias("to"),
        F.pmod(F.xxhash64("grp"), F.lit(256)).alias("_bucket"),
    )


def propagate(members: DataFrame, *, shards: int, capacity: int, rounds: int = 10) -> DataFrame:
    """(``key``, ``grp``, ``shard``) after label propagation under quotas.

    ``members`` has the distinct ``key`` of every linked row and its ``grp``; the rows of one group
    are neighbours. Rows start in the shard of their key's hash. In every round the shard counts of
    a group name its home, and rows elsewhere ask to move there; every other round looks at the room
    left as well. The shards x shards table of wishes is all that reaches the driver, which grants
    exchanges, and moves as far as a capacity of ``capacity`` rows a shard allows. They are granted
    by position in the order of groups, so that whole groups move first. A group larger than a
    shard fills one after the other. Every round ends in a table in the shared folder.
    """
    start = F.pmod(F.xxhash64(F.lit("start"), "key"), F.lit(shards)).cast("int")
    now = stage(members.select("key", "grp", start.alias("shard")), "labels")
    idle = 0
    for k in range(rounds):
        held = _by_shard(now, shards)
        room = [capacity - n for n in held] if k % 2 else None
        wishes = stage(_wishes(now, shards, room), "wishes")
        flows = wishes.groupBy("shard", "to").agg(F.count(F.lit(1)).alias("n")).collect()
        wanted = {(r["shard"], r["to"]): r["n"] for r in flows}
        allowed = _moves(wanted, held, capacity)
        if not wanted and room is None:
            break  # every group is whole
        idle = 0 if allowed else idle + 1
        if idle == 2:
            break
        if not allowed:
            continue
        granted = _small_table(
            now, [(i, j, n) for (i, j), n in allowed.items()], "i int, j int, most long"
        )
        if any(n < wanted[k] for k, n in allowed.items()):
            asked = positions(wishes, ["shard", "to"], "_bucket", [F.col("grp"), F.col("key")], "at")
        else:
            asked = wishes.withColumn("at", F.lit(0).cast("long"))
        moved = (
            asked.join(granted, (F.col("shard") == F.col("i")) & (F.col("to") == F.col("j")))
            .where(F.col("at") < F.col("most"))
            .select("key", "to")
        )
        now = stage(
            now.join(moved, "key", "left").select(
                "key", "grp", F.coalesce("to", "shard").alias("shard")
            ),
            "labels",
        )
    return now


def _first_above(edges: Sequence[int], position: Column) -> Column:
    """Index of the first edge above a position."""
    return F.size(
        F.filter(F.array(*[F.lit(int(e)).cast("long") for e in edges]), lambda e: e <= position)
    )


def _pick(values: Sequence[int], index: Column) -> Column:
    array = F.array(*[F.lit(int(v)).cast("long") for v in values])
    return F.element_at(array, (index + 1).cast("int"))


def balanced_shards(rows: DataFrame, *, shards: int = 24, rounds: int = 10) -> DataFrame:
    """(``key``, ``shard``, ``slot``) of every row; shard counts differ by one at most.

    ``rows`` is a stored table with a distinct ``key`` (long) and the group ``grp`` of each row;
    rows of a group are linked, a null group links to nothing. Linked rows go through
    ``propagate`` with a twentieth more room than a shard has in the end; each shard then keeps as
    many of them as it may hold, in the order of groups. The groups beyond that, and all rows
    without links, fill the shards up, group by group. ``slot`` numbers the rows of a shard from 0
    without a gap. An empty table gives no rows.
    """
    total = rows.count()
    sizes = [total // shards + (j < total % shards) for j in range(shards)]
    groups = rows.where(F.col("grp").isNotNull()).groupBy("grp").agg(F.count(F.lit(1)).alias("_n"))
    linked = stage(
        rows.join(groups.where(F.col("_n") > 1), "grp").select("key", "grp"), "linked"
    )
    capacity = total // shards
    labels = propagate(
        linked, shards=shards, capacity=capacity + max(1, capacity // 20), rounds=rounds
    )
    # groups stand together inside a shard, so that what does not fit comes from few groups
    placed = stage(
        positions(
            labels.withColumn("_bucket", F.pmod(F.xxhash64("grp"), F.lit(256))),
            ["shard"], "_bucket", [F.col("grp"), F.col("key")], "at",
        ),
        "placed",
    )
    room = F.create_map(*[F.lit(x) for j, n in enumerate(sizes) for x in (j, n)])
    kept = placed.where(F.col("at") < room[F.col("shard")])
    held = _by_shard(kept, shards)
    edges, until = [], 0
    for n, have in zip(sizes, held, strict=True):
        until += n - have
        edges.append(until)
    before = [e - (n - have) for e, n, have in zip(edges, sizes, held, strict=True)]
    free = rows.join(kept.select("key"), "key", "left_anti")
    near = F.coalesce(F.xxhash64("grp"), F.xxhash64("key"))
    free = stage(free.withColumn("_bucket", F.pmod(near, F.lit(1024))), "free")
    dealt = positions(free, [], "_bucket", [F.col("grp"), F.col("key")], "at").withColumn(
        "shard", _first_above(edges, F.col("at")).cast("int")
    )
    slot = _pick(held, F.col("shard")) + F.col("at") - _pick(before, F.col("shard"))
    return kept.select("key", "shard", F.col("at").alias("slot")).union(
        dealt.select("key", "shard", slot.alias("slot"))
    )


def with_group(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``row`` (all columns), ``size``, ``text_crc32`` and ``grp``, the md5 of the text.

    ``size`` is the UTF-8 bytes of the text plus 8. A null text has size 8, checksum 0 and no group;
    the empty text is a text like any other.
    """
    text = F.col(f"row.`{text_col}`")
    return as_row(docs).select(
        "row",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("grp"),
    )


def shard_rows(rows: DataFrame, *, shards: int = 24, rounds: int = 10) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``: rows of one ``grp`` are linked.

    The law held is ``rows``: counts differ by one at most. Repeated rows and null ids are rows
    like any other. The rows are stored first, which fixes the key of each.
    """
    stored = stage(rows.withColumn("_key", F.monotonically_increasing_id()), "rows")
    members = stored.select(F.col("_key").alias("key"), "grp")
    dealt = balanced_shards(members, shards=shards, rounds=rounds)
    return stored.join(dealt, stored["_key"] == dealt["key"]).select(
        *[stored[c] for c in rows.columns], "shard", "slot"
    )


def shard_documents(docs: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """Every document with all its columns in ``row``, its ``size``, ``shard`` and ``slot``."""
    return shard_rows(with_group(docs, text_col=text_col), **options)
