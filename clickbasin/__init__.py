"""Event lakehouse on PySpark: landing, curation, quality, reports, governance."""
