"""Plan-level helpers: size-checked broadcast, materialisation, the pipeline."""

from lagframe.plans.guards import broadcast_dimension, materialize

__all__ = ["broadcast_dimension", "materialize"]
