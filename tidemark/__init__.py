"""tidemark: analytics over periodic snapshots of an entity catalogue, on Spark.

Every operator takes and returns a DataFrame and is built from built-in Spark
functions only, so Catalyst plans it and it runs distributed.  The package is
organised as:

* ``sources``   -- snapshot readers, typed raw table, sinks and test bindings
* ``functions`` -- Column -> Column helpers (trim, day age, 32-bit velocity, ...)
* ``operators`` -- staging, ranking, trends, breakouts, metrics, quality, explorer
* ``plans``     -- the batch pipeline, the query catalogue and plan inspection
"""

from tidemark.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
__version__ = "0.1.0"
