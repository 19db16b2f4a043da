"""Seeded samples. The default everywhere else in the library is the whole input."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The sampling shares of the study and its seed.
BIKE_SHARE, TAXI_SHARE, MODE_SHARE = 0.8, 0.15, 0.25
SAMPLE_SEED = 69

_STEPS = 1 << 32


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = SAMPLE_SEED) -> DataFrame:
    """Spark's own row sample; which rows it picks depends on the partition layout."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def keyed_sample(
    df: DataFrame, keys: list[str], fraction: float, seed: int = SAMPLE_SEED
) -> DataFrame:
    """A sample decided by the row's key alone, so any layout picks the same rows."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    step = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return df.filter(step < int(fraction * _STEPS))
