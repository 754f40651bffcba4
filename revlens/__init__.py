"""revlens: product-review analytics expressed as Spark DataFrame / SQL plans.

Subpackages
-----------
sources    schemas, readers / writers, and the adapter that maps the driver's
           test tables onto review roles
functions  column-level expressions (cleaning, labeling, scoring helpers)
operators  DataFrame -> DataFrame operators (quality, cleaning, labeling,
           dashboards, sampling, star schema, metrics, fairness, drift)
plans      end-to-end plans and the query catalogue used by __spark_entry__
streaming  Structured Streaming versions of the live path
"""

__all__ = ["session"]
