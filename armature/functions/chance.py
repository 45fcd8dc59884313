"""Replayable randomness: a hash of (seed, keys), never `rand()`.

A task that is retried after an executor loss draws the same numbers again, and the draw does not depend on how rows
are spread over partitions. Any SQL engine with md5 can reproduce it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(seed: int, *keys: Column | str) -> Column:
    """Uniform double in [0, 1) from 52 bits of md5("seed:key1:key2...")."""
    parts = [F.lit(str(seed))] + [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(2**52))
