"""Scoring a stream of listings with fitted state (M8 on Structured Streaming).

The reference has no streaming; the apply side of every fitted operator is
row-local or a stream–static lookup join, so new listings arriving as files
are scored incrementally with the same code as batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import encoders as EN
from ..operators import scoring as SC


def score_stream(stream: DataFrame, state: EN.FeatureState, model, keep: tuple[str, ...] = ("id",),
                 pct: float = 0.12) -> DataFrame:
    """Streaming DataFrame of (keep..., pred, lo, hi, risk_band)."""
    x = EN.apply_features(stream, state, keep=keep, label=None)
    p = model.transform(x).select(*keep, F.col("prediction").alias("pred"))
    return SC.with_risk_band(SC.with_band(p, "pred", pct))


def run_available(stream: DataFrame, state: EN.FeatureState, model, out_path: str, checkpoint: str,
                  keep: tuple[str, ...] = ("id",)):
    """Score everything currently available, append Parquet to ``out_path``, then stop."""
    q = (score_stream(stream, state, model, keep).writeStream.format("parquet")
         .option("path", out_path).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return q
