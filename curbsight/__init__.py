"""Service-ticket and churn-risk analytics as Spark DataFrame transformations.

Layers, bottom up:

* ``functions``  column expressions (rounding, lookups, ids, text formats)
* ``sources``    readers, writers and catalog access
* ``operators``  ``DataFrame -> DataFrame`` steps: silver, gold, reports, retrieval
* ``plans``      whole jobs put together from operators
* ``streaming``  the silver step over a stream of ticket files
"""
