"""Inverted index over the eight positional bytes of 64-bit SimHash fingerprints, with count filtering.

Two fingerprints that differ in at most ``d`` bits share at least ``8 - d`` positional bytes. The index
lists every fingerprint under each choice of so many positions: whoever shares a posting list has
reached the least number of matches.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

BYTES = 8
_BLOCK = 1 << 16


def majority(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half of the hashes; 0 without hashes."""
    counts = np.zeros(64, np.int64)
    values = hashes.astype(">u8").view(np.uint8).reshape(-1, BYTES)
    for at in range(0, len(values), _BLOCK):
        counts += np.unpackbits(values[at : at + _BLOCK], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def choices(least: int) -> list[tuple[int, ...]]:
    """The sets of positions under which fingerprints are listed that share ``least`` bytes."""
    return list(combinations(range(BYTES), least))


def mask(positions: tuple[int, ...]) -> int:
    """The bits of some positional bytes, as a signed long."""
    value = sum(0xFF << (8 * p) for p in positions)
    return value - (1 << 64) if value >> 63 else value


def postings(fp: Column, least: int, *, first: int = 0) -> Column:
    """Structs (``c``, ``k``) of the lists of a fingerprint: the choice, numbered from ``first``, and its bytes."""
    return F.array(
        *[
            F.struct(F.lit(i).cast("byte").alias("c"), fp.bitwiseAND(F.lit(mask(c))).alias("k"))
            for i, c in enumerate(choices(least), first)
        ]
    )


def shared_bytes(a: Column, b: Column) -> Column:
    """The tally of positional bytes that two fingerprints share."""
    mixed = a.bitwiseXOR(b)
    tally = F.lit(0)
    for p in range(BYTES):
        tally = tally + F.when(mixed.bitwiseAND(F.lit(mask((p,)))) == 0, 1).otherwise(0)
    return tally


def reached(a: Column, b: Column, *, least: int, most_bits: int) -> Column:
    """Do two fingerprints share ``least`` positional bytes and differ in ``most_bits`` bits at most?"""
    return (shared_bytes(a, b) >= least) & (F.bit_count(a.bitwiseXOR(b)) <= most_bits)
