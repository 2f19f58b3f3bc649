"""tablefit: tabular profiling, feature preparation and model selection on Spark.

Every operator takes and returns ``pyspark.sql.DataFrame`` objects (or fitted
``pyspark.ml`` models) and leaves the physical plan to Catalyst.  Modules:

* ``tablefit.sources``   loading, schema repair, the stand-in tables
* ``tablefit.functions`` column expressions shared by the operators
* ``tablefit.operators`` profile, derive, features, split, models, evaluate, tune
* ``tablefit.plans``     the query catalogue (Spark side and DuckDB oracle)
* ``tablefit.streaming`` scoring and running confusion counts on streams
"""

from tablefit.session import checkpoint_root, cut_lineage, get_session, scratch_path

__all__ = ["checkpoint_root", "cut_lineage", "get_session", "scratch_path"]
