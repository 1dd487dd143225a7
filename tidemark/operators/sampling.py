"""Row samples and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SLOTS = 1 << 60


def sample_rows(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Bernoulli sample. Depends on the partitioning; see ``sample_keys``."""
    return df.sample(fraction=fraction, seed=seed)


def split_rows(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Random split. Depends on the partitioning; see ``split_keys``."""
    return df.randomSplit([float(w) for w in weights], seed=seed)


def key_slot(keys: Sequence[str], seed: int) -> Column:
    """A uniform slot in ``[0, SLOTS)`` that depends on the key and seed alone, as 15 hexadecimal digits.

    The first 60 bits of an MD5 over seed and keys as text (NULL is empty), so other
    engines find the same slot.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return F.substring(F.md5(text), 1, 15)


def _between(digits: Column, lo: int, hi: int) -> Column:
    """Digits of one length compare like the numbers; ends that bound nothing cost nothing."""
    if lo >= SLOTS:
        return F.lit(False)
    held = F.lit(True) if lo <= 0 else digits >= f"{lo:015x}"
    return held if hi >= SLOTS else held & (digits < f"{hi:015x}")


def _edge(share: float) -> int:
    return min(SLOTS, round(share * SLOTS))


def sample_keys(df: DataFrame, keys: Sequence[str], fraction: float, seed: int) -> DataFrame:
    """Sample that keeps or drops a key as a whole and survives re-partitioning."""
    return df.filter(_between(key_slot(keys, seed), 0, _edge(fraction)))


def split_keys(df: DataFrame, keys: Sequence[str], weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Disjoint, complete parts by key hash. A lost executor cannot move a row."""
    total = float(sum(weights))
    edges = [0] + [_edge(sum(weights[:i + 1]) / total) for i in range(len(weights))]
    slot = key_slot(keys, seed)
    return [df.filter(_between(slot, lo, hi)) for lo, hi in zip(edges, edges[1:])]
