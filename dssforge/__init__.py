"""Decision-support analytics on PySpark.

Sub-packages:

* ``sources``   -- typed table catalog (Parquet folders or catalog tables),
                   delimited text load/write, dataset loading, run logs
* ``functions`` -- shared column expressions (exact money, dates) and fixed values
* ``plans``     -- the 22 parametrised queries, variants, parameter files, SQL oracles
* ``operators`` -- integrity checks, business rules, refresh sets, layout,
                   reports, result comparison, window helpers
* ``streaming`` -- file-stream refresh

``python -m dssforge DATA_DIR [KEY ...]`` runs registered queries from a shell.
"""

__version__ = "0.1.0"
