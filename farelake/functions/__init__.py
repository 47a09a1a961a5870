"""Column expressions: pure functions that return :class:`pyspark.sql.Column`.

All of them are built-in Spark expressions, so they run inside whole-stage
codegen; none is a Python UDF.
"""
