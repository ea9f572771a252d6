"""metaweave: a Spark-native metadata catalog pipeline.

Raw catalog listings, DESCRIBE output, commit logs and relational catalog
columns are ordinary tables.  Every operator is a ``DataFrame -> DataFrame``
function built from Spark built-in expressions, so Catalyst plans the whole
pipeline and nothing passes through the driver.

Layout:

* ``sources``    landed raw tables, test fixtures, CSV/JSON hand-off, index publish
* ``operators``  scope, DESCRIBE interpretation, details, records, graph, search
* ``functions``  column expressions and skew-safe ordered helpers
* ``plans``      end-to-end pipelines and plan checks
* ``streaming``  incremental catalog refresh with Structured Streaming
"""

from metaweave.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
