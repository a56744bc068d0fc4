"""A PySpark engine for curating and auditing document datasets."""
