"""Operators for preparing training data. Nothing else in the library imports
this subpackage; `queries` lists what `__spark_entry__.py` registers."""
