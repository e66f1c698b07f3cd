"""Join helper. Strategies are left to Spark: sizes it knows (a stored table, a measured stage)
decide about broadcasts, nothing is counted for it."""

from __future__ import annotations

from pyspark.sql import DataFrame


def restrict_to(big: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows of ``big`` whose key occurs in ``keys``.

    Used before a left join of a small driving set to a large dimension: a semi join may broadcast
    the keys and filter the large side where it is scanned, which a left join cannot.
    """
    cols = [on] if isinstance(on, str) else list(on)
    return big.join(keys.select(*cols).distinct(), cols, "left_semi")
