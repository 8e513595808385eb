"""Stream and table analytics operators written as plain PySpark DataFrame functions."""

__version__ = "0.1.0"
