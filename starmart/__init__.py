"""starmart: a PySpark-native star-schema builder for arrival, temperature,
demographics and country-code data.

Every step is a DataFrame / SQL expression that Catalyst can optimise; no
Python UDF runs in any plan.  Sub-packages:

- ``sources``   readers, writers and the bindings of the driver's test tables
- ``functions`` column expressions (SAS dates, calendar parts, title case, missing)
- ``operators`` cleaning, profiling, surrogate keys, size-checked lookup joins
- ``plans``     dimension/fact builders, quality checks, analytics, pipeline
- ``streaming`` incremental ingestion of new arrival files
"""

__version__ = "0.1.0"
