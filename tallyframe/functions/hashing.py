"""Row choices that depend on a key and a seed, not on how rows are partitioned.

``randomSplit`` and ``sampleBy`` draw per partition: the same seed gives other rows
after a repartition, a retry on re-read input or a change of cluster size. A hash
of the row's key gives the same rows every time, and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyframe.functions.columns import named


def hash_unit(key: str | list[str], seed: int = 42, stream: str = "") -> Column:
    """A number in [0, 1) made from the row's key.

    ``stream`` names the purpose ("sample", "fold", ...), so that two choices with
    one seed are independent: without it, a row kept by a 30 % sample would always
    fall in the first 80 % of a split. A NULL in the key raises an error when the row is
    reached: rows without a key would all fall in one part. Of a key of several columns, each
    part's length goes along, so that different keys are different texts.
    """
    names = [key] if isinstance(key, str) else list(key)
    prefix = f"{seed}:{stream}:" if stream else f"{seed}:"
    parts = [
        F.coalesce(
            named(name).cast("string"),
            F.raise_error(F.lit(f"the key column {name!r} holds NULL")).cast("string"),
        )
        for name in names
    ]
    if len(parts) > 1:
        parts = [F.concat(F.length(part).cast("string"), F.lit(":"), part) for part in parts]
    digest = F.md5(F.concat(F.lit(prefix), *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(2**32))


def hash_part(unit: Column, weights: Mapping[str, float]) -> Column:
    """Name of the part a unit number falls in; weights are taken in order."""
    total = float(sum(weights.values()))
    if total <= 0 or min(weights.values()) < 0:
        raise ValueError("weights must be non-negative with a positive sum")
    names = list(weights)
    part, upper = None, 0.0
    for name in names[:-1]:
        upper += weights[name] / total
        hit = unit < F.lit(upper)
        part = F.when(hit, name) if part is None else part.when(hit, name)
    return F.lit(names[-1]) if part is None else part.otherwise(names[-1])
