"""Column-level helpers built from pyspark.sql.functions (JVM-side)."""
