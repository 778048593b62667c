"""Layered sales analytics as plain PySpark DataFrame jobs.

The library is organised by the kind of thing a caller composes:

* ``sources``   readers, sinks and the shared working folder
* ``functions`` column expressions (money, quality rules)
* ``operators`` reusable DataFrame operators (latest-per-key, versioned tables, schema checks)
* ``plans``     the bronze, silver and gold layers, the reports and the end-to-end run
* ``streaming`` the click-event ingest
"""
