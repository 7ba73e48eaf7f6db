"""Daily valuation of marketplace transactions in US dollars, as Spark jobs.

Layers, bottom up:

* ``functions``  column expressions (JSON members, numbers, dates, prices)
* ``sources``    readers that return DataFrames
* ``operators``  DataFrame -> DataFrame steps, plus the sinks
* ``plans``      whole jobs composed of the above
* ``streaming``  the same refresh fed by newly arrived files

There is no Python UDF anywhere: every row is handled by Spark built-ins.
"""
