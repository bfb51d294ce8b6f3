"""Seeded integer hash of a row id, in plain BIGINT arithmetic so every engine gives the same value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRIME = 2147483647
MULTIPLIER = 1103515245
HIGH_MULTIPLIER = 1812433253
SEED_STEP = 1299709
SECOND_SEED = 500_000

# Poisson(1) cumulative probabilities P(X <= k), k = 0..8.
POISSON_ONE_CDF = (
    0.36787944, 0.73575888, 0.91969860, 0.98101184, 0.99634015,
    0.99940582, 0.99991676, 0.99998975, 0.99999887,
)


def id_hash(key: str, seed: int | str) -> Column:
    """Hash in [0, PRIME) of an integer key; key and seed are SQL text.

    A permutation of the keys below PRIME - 1 for every seed below one million. Larger keys enter with both words, so
    keys that lie multiples of PRIME apart have unrelated hashes.
    """
    start = (f"((pmod(CAST({key} AS BIGINT) + 1, {PRIME}L) * {MULTIPLIER}L % {PRIME}L "
             f"+ pmod((CAST({key} AS BIGINT) + 1) DIV {PRIME}L, {PRIME}L) * {HIGH_MULTIPLIER}L % {PRIME}L + CAST({seed} AS BIGINT) * {SEED_STEP}L) % {PRIME}L)")
    square = f"({start} * {start} % {PRIME}L)"
    return F.expr(f"{square} * {square} % {PRIME}L * {start} % {PRIME}L")


def draw_position(key: str, seed: int, size: int) -> Column:
    """Position in [0, size) from two hashes of the key, 62 bits together, so that large tables are drawn from evenly."""
    return (id_hash(key, seed) * F.lit(PRIME).cast("bigint") + id_hash(key, f"({seed} + {SECOND_SEED})")) % F.lit(size)


def hash_number(number: int, seed: int) -> int:
    """The same hash of a plain number, for small facts such as column positions."""
    x = ((number + 1) % PRIME * MULTIPLIER % PRIME + (number + 1) // PRIME % PRIME * HIGH_MULTIPLIER % PRIME + seed * SEED_STEP) % PRIME
    return pow(x, 5, PRIME)


def unit_hash(key: str, seed: int | str) -> Column:
    return id_hash(key, seed) / F.lit(float(PRIME))


def poisson_draws(unit: str) -> Column:
    """Draws of a row into a bootstrap sample as large as the table, from the column with its uniform number."""
    return F.expr(" + ".join(f"CASE WHEN {unit} >= {bound!r}D THEN 1 ELSE 0 END" for bound in POISSON_ONE_CDF))


def left_out(unit: Column) -> Column:
    """True when the row is not drawn at all."""
    return unit < POISSON_ONE_CDF[0]
