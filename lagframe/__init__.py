"""lagframe: lagged event/observation analytics on PySpark.

Turns scheduled transport legs plus per-station observations into a
model-ready table: typed cleaning, local-time resolution, lagged
two-endpoint joins (long or wide layout), sparse-column profiling,
mean imputation, labelling and a PCA + random forest classifier.
Every operator is a DataFrame transformation left to Catalyst and AQE.
"""

from lagframe.session import checkpoint_dir, configure, get_session

__all__ = ["checkpoint_dir", "configure", "get_session"]
