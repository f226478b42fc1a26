"""tripflow: origin/destination trip analytics on Spark DataFrames.

Every public function takes and returns DataFrames (or Columns) and leaves
physical planning to Catalyst/AQE. No Python UDF runs in any plan.
"""

__version__ = "0.1.0"
