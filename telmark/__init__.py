"""Telemetry fact pipeline and corpus operators on PySpark."""
