"""deskspark: support-ticket text analytics as Spark DataFrame jobs.

Every operator is a ``DataFrame -> DataFrame`` function built from native
Spark SQL expressions (Catalyst-optimised, whole-stage codegen) or MLlib
estimators.  Sub-packages:

* ``sources``   - table scans, required-column checks, sinks
* ``functions`` - Column-expression builders (cleaning, PII, tokens)
* ``operators`` - preparation, profiling, TF-IDF, models, evaluation,
                  PII / routing, monitoring
* ``plans``     - named end-to-end queries over the driver tables and
                  their DuckDB oracle SQL
* ``streaming`` - Structured Streaming versions of the request path and
                  of the monitoring aggregates
"""

from deskspark.config import Params

__all__ = ["Params"]
