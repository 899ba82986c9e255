"""Incremental star-schema loading as Spark DataFrame operators.

Operators take DataFrames and return DataFrames.  Only ``sinks`` and
``plans.warehouse`` write tables; ``operators.numbering`` also stages its input
in the shared scratch folder (see ``scratch``).
"""
