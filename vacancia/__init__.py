"""Vacancia: job-posting market analytics as Spark DataFrame operators.

The package is split by what a caller needs:

* ``functions``  -- Column expressions (text, dates, arrays, label rules)
* ``operators``  -- DataFrame -> DataFrame operators, generic over column names
* ``sources``    -- landing tables, logs, documents, pages, snapshots
* ``plans``      -- the posting pipeline and the analytics built on its mart
* ``streaming``  -- incremental landing
"""
