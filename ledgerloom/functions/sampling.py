"""Reproducible random numbers made from row keys.

``rand()`` changes when a lost task is run again on other partitions, and no other
engine can repeat it.  Here every draw is a pure function of (seed, row key, replicate)
in integer arithmetic, so results do not depend on partitioning or retries.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numeric import let

# 32-bit mask, multiplier of a two-round xor-shift mixer, golden-ratio step.
MASK32 = 4294967295
MIX_MULTIPLIER = 73244475
GOLDEN_STEP = 2654435769

# Bits of a fine draw: as many as a double holds exactly.
FINE_BITS = 53

# Largest count a Poisson(1) weight can take (the chance of more is below 2**-32).
POISSON_TOP = 12


def _low32(x: Column) -> Column:
    return x.bitwiseAND(F.lit(MASK32))


def _scatter(x: Column) -> Column:
    return _low32(F.shiftright(x, 16).bitwiseXOR(x) * F.lit(MIX_MULTIPLIER))


def _fold(x: Column) -> Column:
    return F.shiftright(x, 16).bitwiseXOR(x)


def mix32(x: Column) -> Column:
    """Scatter a 32-bit number (held in a BIGINT) over the 32-bit range."""
    for step in (_scatter, _scatter, _fold):
        x = let(x, step)
    return x


def with_mixed(df: DataFrame, name: str, start: Column) -> DataFrame:
    """``mix32`` of a number as a new column, one projection per step.

    Each step names the step before several times; as separate projections the steps
    stay small compiled code, which matters once per row and replicate.
    """
    df = df.withColumn(name, start)
    for step in (_scatter, _scatter, _fold):
        df = df.withColumn(name, step(F.col(name)))
    return df


def _rounds(low: Column, high: Column, seed: int) -> tuple[Column, list]:
    """Start and steps of a three-round Feistel network over the halves of a key.

    The network is a permutation of the 64-bit numbers: two keys never share a hash.
    """
    steps = [
        lambda x: _low32(x + F.lit(GOLDEN_STEP)),
        lambda x: _low32(x + F.lit(2 * GOLDEN_STEP)),
    ]
    return low.bitwiseXOR(F.lit(seed & MASK32)), steps


def with_key_hash(df: DataFrame, name: str, key: Column, seed: int) -> DataFrame:
    """64-bit hash of a BIGINT row key as two new 32-bit columns, ``name`` and ``name_b``."""
    key, other, first, second = key.cast("bigint"), f"{name}_b", f"{name}_x", f"{name}_y"
    df = df.withColumns({name: _low32(F.shiftright(key, 32)), other: _low32(key)})
    start, (next_, last) = _rounds(F.col(other), F.col(name), seed)
    df = with_mixed(df, first, start).withColumn(name, F.col(name).bitwiseXOR(F.col(first)))
    df = with_mixed(df, second, next_(F.col(name)))
    df = df.withColumn(other, F.col(other).bitwiseXOR(F.col(second)))
    df = with_mixed(df, first, last(F.col(other)))
    return df.withColumn(name, F.col(name).bitwiseXOR(F.col(first))).drop(first, second)


def with_draw(df: DataFrame, name: str, hashed: str, replicate: str) -> DataFrame:
    """Uniform integer in [0, 2**32) for one row and one replicate as a new column.

    Both halves of the row's hash enter, so no two rows share their draws in all replicates.
    """
    step = F.col(replicate).cast("bigint") * F.lit(GOLDEN_STEP)
    df = with_mixed(df, name, _low32(F.col(hashed) + step))
    return with_mixed(df, name, F.col(name).bitwiseXOR(F.col(f"{hashed}_b")))


def with_fine_draw(df: DataFrame, name: str, coarse: str, hashed: str) -> DataFrame:
    """Uniform integer in [0, 2**53) that continues the draw ``coarse`` of ``with_draw``."""
    rest = f"{name}_rest"
    df = with_mixed(df, rest, _low32(F.col(coarse) + F.col(f"{hashed}_b")))
    fine = F.shiftleft(F.col(coarse), FINE_BITS - 32) + F.shiftright(F.col(rest), 64 - FINE_BITS)
    return df.withColumn(name, fine).drop(rest)


def with_second_draw(df: DataFrame, name: str, other: str, coarse: str, hashed: str) -> DataFrame:
    """Two more 32-bit draws, ``name`` and ``other``, that follow from ``coarse``."""
    df = with_mixed(df, name, _low32(F.col(coarse) + F.lit(2 * GOLDEN_STEP)))
    return with_mixed(df, other, F.col(name).bitwiseXOR(F.col(hashed)))


def scattered_place(place: Column, key: Column, other: Column, bits: int) -> Column:
    """Another number below ``2**bits``, different for different places of one pair of keys.

    Adding, multiplying by an odd number and folding the upper half down are each
    one-to-one; ``key`` and ``other`` are 32-bit draws.
    """
    mask, half = F.lit((1 << bits) - 1), (bits + 1) // 2
    for shift in (0, 8, 16):
        added = (place + F.shiftright(key, shift)).bitwiseAND(mask)
        odd = F.shiftright(other, shift).bitwiseOR(F.lit(1)).bitwiseAND(mask)
        place = let((added * odd).bitwiseAND(mask), lambda x: x.bitwiseXOR(F.shiftright(x, half)))
    return place


def binomial_cuts(trials: int, chance: float) -> list[int]:
    """Cumulative probabilities of 0, 1, 2, ... successes, scaled to the range of a fine draw."""
    part = total = (1 - chance) ** trials
    cuts = []
    for k in range(trials):
        cuts.append(int(total * float(1 << FINE_BITS)))
        if cuts[-1] >= 1 << FINE_BITS or (k > trials * chance and part < 2.0**-60):
            break
        part = part * (trials - k) / (k + 1) * chance / (1 - chance) if chance < 1 else 0.0
        total += part
    return cuts


def binomial_count(draw: Column, trials: int, chance: float) -> Column:
    """Number of successes of a uniform fine draw."""
    cuts = binomial_cuts(trials, chance)
    choice = F.when(draw < cuts[0], F.lit(0))
    for count, cut in enumerate(cuts[1:], start=1):
        choice = choice.when(draw < cut, F.lit(count))
    return choice.otherwise(F.lit(len(cuts)))


def uniform_draw(key: Column, seed: int) -> Column:
    """Uniform double in [0, 1) from a BIGINT row key: 53 bits of its 64-bit hash."""
    key = key.cast("bigint")
    low, high = _low32(key), _low32(F.shiftright(key, 32))
    start, (next_, last) = _rounds(low, high, seed)

    def whole(a: Column) -> Column:
        return let(
            low.bitwiseXOR(mix32(next_(a))),
            lambda b: (
                F.shiftleft(a.bitwiseXOR(mix32(last(b))), FINE_BITS - 32)
                + F.shiftright(b, 64 - FINE_BITS)
            ) / F.lit(float(1 << FINE_BITS)),
        )

    return let(high.bitwiseXOR(mix32(start)), whole)


def poisson_cuts() -> list[int]:
    """Cumulative Poisson(1) probabilities for 0, 1, 2, ... scaled to 2**32."""
    total, cuts = 0.0, []
    for k in range(POISSON_TOP):
        total += math.exp(-1) / math.factorial(k)
        cuts.append(int(total * 2**32))
    return cuts


def poisson_weight(draw: Column) -> Column:
    """Poisson(1) count of a uniform 32-bit draw: how often a bootstrap picks the row."""
    cuts = poisson_cuts()
    choice = F.when(draw < cuts[0], F.lit(0))
    for count, cut in enumerate(cuts[1:], start=1):
        choice = choice.when(draw < cut, F.lit(count))
    return choice.otherwise(F.lit(len(cuts)))


def power_cuts(exponent: int) -> tuple[int, list[int]]:
    """Poisson counts with a mean of ``2**exponent``: the least count and the cuts of a fine draw.

    Ten deviations to both sides; what lies beyond is less likely than a step of the draw.
    """
    mean = 2.0**exponent
    reach = 10 * math.sqrt(mean) + 10
    low, high = max(0, math.floor(mean - reach)), math.ceil(mean + reach)
    total, cuts = 0.0, []
    for k in range(low, high + 1):
        total += math.exp(k * math.log(mean) - mean - math.lgamma(k + 1))
        cuts.append(int(total * float(1 << FINE_BITS)))
    return low, cuts


def place_in(sorted_values: Column, x: Column, longest: int) -> Column:
    """Number of values up to ``x`` in a sorted array of at most ``longest``, by halving."""
    steps = [F.lit(1 << power) for power in reversed(range(longest.bit_length()))]

    def halved(place: Column, step: Column) -> Column:
        passed = F.get(sorted_values, place + step - 1) <= x
        return F.when(passed, place + step).otherwise(place)

    return F.aggregate(F.array(*steps), F.lit(0), halved)
