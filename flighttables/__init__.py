"""flighttables — flight-telemetry lake operators written as Spark DataFrame / SQL plans.

Sub-packages:

* ``functions``  Column -> Column scalar expressions (names, times, levels, byte text, types)
* ``operators``  DataFrame -> DataFrame operators (curated views, catalog selection,
                 unflattening, trajectory, ordered merge, schema evolution, series, stats)
* ``sources``    table / file / message readers and catalog inspection
* ``sinks``      partitioned topic-table writers
* ``plans``      registered queries over the driver tables and their DuckDB oracles
* ``streaming``  incremental ingest through ``foreachBatch``
"""

__all__ = ["functions", "operators", "sources", "sinks", "plans", "streaming"]
