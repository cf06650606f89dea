"""Trip analytics on Spark.

Operators are plain ``DataFrame -> DataFrame`` functions built from
``pyspark.sql.functions``; nothing here creates a session except
``trip_engine.session.build_session`` (used by jobs, tests and bench).
"""

__version__ = "0.1.0"
