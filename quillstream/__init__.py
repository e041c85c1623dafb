"""quillstream: document ingestion and corpus processing on PySpark DataFrames."""
