"""adloom: marketing-analytics staging, mart and data checks on PySpark."""
