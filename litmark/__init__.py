"""Litmark: medallion indicator tables (Bronze, Silver, Gold) as Spark DataFrame operators."""
