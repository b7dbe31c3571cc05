"""rollbook: attendance and programme-reporting operators on Spark DataFrames.

Every public function takes and returns lazy ``DataFrame`` / ``Column``
objects built from ``pyspark.sql.functions``; nothing collects data to the
driver. See README.md for the layout.
"""

__version__ = "0.1.0"
