"""Running sums over arrays, and the polynomials they make, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.numeric import let

# Values summed one after the other; a running sum copies what it has at every step.
SUM_BLOCK = 256


def sums_before(values: Column, kind: str = "int") -> Column:
    """Sum of all values before each one, block by block, so the work stays linear."""
    zero = F.lit(0).cast(kind)
    start = F.struct(zero.alias("sum"), F.array().cast(f"array<{kind}>").alias("before"))

    def add(state: Column, value: Column) -> Column:
        return F.struct(
            (state["sum"] + value).cast(kind).alias("sum"),
            F.array_append(state["before"], state["sum"]).alias("before"),
        )

    summed = lambda some: F.aggregate(some, start, add)

    def blocks(some: Column) -> Column:
        last = F.greatest(F.ceil(F.size(some) / SUM_BLOCK).cast("int") - 1, F.lit(0))
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda block: summed(F.slice(some, block * SUM_BLOCK + 1, F.lit(SUM_BLOCK))),
        )

    def joined(parts: Column) -> Column:
        offsets = summed(F.transform(parts, lambda part: part["sum"]))["before"]
        moved = F.zip_with(
            parts, offsets, lambda part, offset: F.transform(part["before"], lambda x: x + offset)
        )
        return F.flatten(moved)

    return let(let(values, blocks), joined)


def rank_sum_ways(small: Column, large: Column, most: Column) -> Column:
    """Ways of two samples to have a U statistic of 0, 1, ..., ``most``, as doubles.

    The counts of samples of ``i`` and ``large`` values follow from those of ``i - 1``: a
    polynomial times ``1 - q**(large + i)``, divided by ``1 - q**i``, which is a running sum
    in steps of ``i``.  An entry depends on the ones before it only, so a cut list is exact
    as far as it goes.
    """

    def every(a: Column, i: Column) -> Column:
        """Running sums of every ``i``-th entry, one list for each remainder."""
        return F.transform(
            F.sequence(F.lit(0), i - 1),
            lambda r: let(
                F.filter(a, lambda x, j: j % i == r),
                lambda own: F.zip_with(own, sums_before(own, "double"), lambda x, before: x + before),
            ),
        )

    def divided(a: Column, i: Column) -> Column:
        return let(
            every(a, i),
            lambda found: F.transform(a, lambda x, j: F.get(F.get(found, j % i), F.floor(j / i).cast("int"))),
        )

    def grown(old: Column, i: Column) -> Column:
        back = large.cast("int") + i
        cut = F.transform(old, lambda x, j: x - F.when(j >= back, F.get(old, j - back)).otherwise(0.0))
        return let(cut, lambda a: divided(a, i))

    none = F.transform(F.sequence(F.lit(0), most.cast("int")), lambda j: F.when(j == 0, 1.0).otherwise(0.0))
    return F.aggregate(F.sequence(F.lit(1), small.cast("int")), none, grown)
