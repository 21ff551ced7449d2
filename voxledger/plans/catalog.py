"""All registered queries, one module per inventory section."""

from . import (q_drift, q_evaluate, q_frames, q_models, q_prep, q_relational,  # noqa: F401
               q_sources, q_spectral, q_stats, q_streams, q_voice)
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
