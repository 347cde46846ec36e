"""Claims flattening, mart models, table checks and calendar operators for PySpark."""

__version__ = "0.1.0"
