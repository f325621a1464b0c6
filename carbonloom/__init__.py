"""Emissions and air-quality warehousing as Spark DataFrame operators."""
