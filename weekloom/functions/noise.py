"""Random draws that depend on row values only.

``rand(seed)`` changes with the partitioning and with retried tasks. These draws hash the
row key with a seed, so a generated table is the same on any cluster.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(seed: int, *key: Column, stream: int = 0) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in key], F.lit(str(stream))))


def uniform(hashed: Column, part: int) -> Column:
    """Uniform in (0, 1) from 32 bits of a digest; ``part`` is 0 to 3."""
    word = F.conv(F.substring(hashed, 1 + 8 * part, 8), 16, 10).cast("bigint")
    return (word + F.lit(0.5)) / F.lit(float(2**32))


def normal(hashed: Column, part: int) -> Column:
    """Standard normal from the parts ``part`` and ``part + 1``."""
    radius = F.sqrt(F.lit(-2.0) * F.ln(uniform(hashed, part)))
    return radius * F.cos(F.lit(2 * math.pi) * uniform(hashed, part + 1))
