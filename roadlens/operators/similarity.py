"""Hamming similarity join of 64-bit fingerprints."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.functions.fingerprint import hamming
from roadlens.session import materialize, shuffled

#: Distinct fingerprints up to which 1, 2, 3 bands make a key; beyond the last, 4.
KEYED_UP_TO = (1 << 14, 1 << 22, 1 << 28)


def bands(n: int, bits: int = 64) -> list[tuple[int, int]]:
    """(shift, width) of n bands that cover all bits."""
    widths = [bits // n + (i < bits % n) for i in range(n)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


def _mask(shift: int, width: int) -> int:
    """The band's bits as a signed 64-bit number."""
    m = ((1 << width) - 1) << shift
    return m - (1 << 64) if m >= 1 << 63 else m


def _equal_bands(x: Column, y: Column, own: list[tuple[int, int]]) -> Column:
    """Bit i is set where band i of both is equal."""
    out = F.lit(0)
    for i, b in enumerate(own):
        out = out + F.when(x.bitwiseXOR(y).bitwiseAND(F.lit(_mask(*b))) == 0, 1 << i).otherwise(0)
    return out


def band_keys(items: DataFrame, threshold: int, together: int) -> DataFrame:
    """``items`` once for each choice of ``together`` of threshold + together bands: bands (bits of the choice), value, below (bits of the bands that would make an earlier choice)."""
    own = bands(threshold + together)
    keys = []
    for chosen in combinations(range(len(own)), together):
        bits = sum(1 << i for i in chosen)
        below = ((1 << chosen[-1]) - 1) & ~bits
        value = F.col("fp").bitwiseAND(F.lit(sum(_mask(*own[i]) for i in chosen)))
        keys.append(F.struct(F.lit(bits).alias("bands"), value.alias("value"), F.lit(below).alias("below")))
    return items.select("*", F.explode(F.array(*keys)).alias("k")).select(*items.columns, "k.bands", "k.value", "k.below")


def _below(bands: Column) -> Column:
    """``below`` of ``band_keys``, from the bits of a choice: those under its highest that aren't its own."""
    upto = bands
    for n in (1, 2, 4, 8):
        upto = upto.bitwiseOR(F.shiftright(upto, n))
    return F.shiftright(upto, 1).bitwiseAND(F.bitwise_not(bands))


def first_choice(a: Column, b: Column, below: Column, threshold: int, together: int) -> Column:
    """Whether no earlier choice of bands is common to both fingerprints: each pair is told once."""
    return _equal_bands(a, b, bands(threshold + together)).bitwiseAND(below) == 0


def near_prints(distinct: DataFrame, threshold: int, together: int | None = None) -> DataFrame:
    """(fa, fb, distance) with fa < fb of distinct fingerprints ``fp`` within the threshold.

    Exact: of threshold + k bands, two fingerprints within the threshold agree in k at
    least, so an equi-join on all choices of k bands finds them. k, ``together``, only
    trades rows for selectivity; by default it grows with the number of fingerprints:
    keys of 9, 16, 21 and 25 bits at a threshold of 6. A pair counts for its first k
    common bands alone.
    """
    k = together or 1 + sum(distinct.count() > most for most in KEYED_UP_TO)
    keyed = band_keys(distinct.select("fp"), threshold, k).drop("below")
    # Spark sizes the keys as if there were one a fingerprint, and would broadcast all 7 to 210 of each. Both sides are the same rows, shuffled once.
    left, right = keyed.withColumnRenamed("fp", "fa"), keyed.withColumnRenamed("fp", "fb")
    a, b = F.col("fa"), F.col("fb")
    pairs = left.join(shuffled(right), ["bands", "value"]).where((a < b) & (hamming(a, b) <= threshold))
    return pairs.where(first_choice(a, b, _below(F.col("bands")), threshold, k)).select("fa", "fb", hamming(a, b).alias("distance"))


def near_pairs(items: DataFrame, threshold: int = 6, across: str | None = None, together: int | None = None) -> DataFrame:
    """(id_a, id_b, distance) with id_a < id_b of all pairs within the threshold.

    ``across`` names a column in which the two must differ; it is returned for both.
    Null fingerprints have no pairs. Equal fingerprints give all their pairs, as asked:
    ``near_edges`` is for grouping.
    """
    known = items.where("fp IS NOT NULL")
    distinct = materialize(known.select("fp").distinct())
    every = near_prints(distinct, threshold, together).unionByName(distinct.select(F.col("fp").alias("fa"), F.col("fp").alias("fb"), F.lit(0).alias("distance")))
    item = F.struct("id", *[F.col(across)] if across else [])
    a, b = known.select(F.col("fp").alias("fa"), item.alias("a")), known.select(F.col("fp").alias("fb"), item.alias("b"))
    joined = every.join(shuffled(a), "fa").join(shuffled(b), "fb").where((F.col("fa") != F.col("fb")) | (F.col("a.id") < F.col("b.id")))
    ordered = joined.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "distance")
    out = ["id"] if not across else ["id", across]
    if across:
        ordered = ordered.where(F.col(f"a.{across}") != F.col(f"b.{across}"))
    return ordered.select(*[F.col(f"{side}.{c}").alias(f"{c}_{side}") for c in out for side in "ab"], "distance")


def near_edges(items: DataFrame, threshold: int = 6, together: int | None = None) -> DataFrame:
    """(id_a, id_b): edges that link what ``near_pairs`` links, each item of a fingerprint to its smallest: linear in equal ones."""
    known = items.where("fp IS NOT NULL").select("id", "fp")
    first = materialize(known.groupBy("fp").agg(F.min("id").alias("first")))
    one, two = first.select(F.col("fp").alias("fa"), F.col("first").alias("id_a")), first.select(F.col("fp").alias("fb"), F.col("first").alias("id_b"))
    between = near_prints(first.select("fp"), threshold, together).join(shuffled(one), "fa").join(shuffled(two), "fb").select("id_a", "id_b")
    return between.unionByName(known.join(shuffled(first), "fp").where("id <> first").select(F.col("first").alias("id_a"), F.col("id").alias("id_b")))
