"""Table movement, enrichment, data quality and catalog queries on PySpark."""
