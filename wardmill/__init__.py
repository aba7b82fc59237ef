"""wardmill: reporting tables from observation-level clinical records, as plain Spark jobs.

Layers
------
operators   relational and temporal building blocks (joins, windows, aggregates)
functions   column expressions and the batch lookups built from the operators
sources     site readers, schema contract, partitioned warehouse writer
plans       extraction jobs and derived-table jobs
streaming   entity-level incremental refresh, batch and foreachBatch
catalog     the registered queries over the driver tables, with their SQL twins
"""
