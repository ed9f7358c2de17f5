"""Quillstone: document, catalog and training-data operators for PySpark."""
