"""tessera: tile-based pixel tables on Spark.

DataFrame-in, DataFrame-out operators for building, cleaning, sampling,
scoring and predicting over wide pixel tables keyed by ``(tile, pixel_idx)``.
"""

from tessera.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
