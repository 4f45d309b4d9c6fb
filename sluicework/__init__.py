"""Config-driven batch and streaming data pipelines on PySpark.

A pipeline spec names inputs, one Spark SQL query and outputs.  The runner in
``sluicework.plans`` executes it; ``sluicework.operators`` holds the
DataFrame -> DataFrame operators that pipelines and hooks are built from.
"""

__version__ = "0.1.0"
