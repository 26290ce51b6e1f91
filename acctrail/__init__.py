"""acctrail: customer product-history analytics as Spark DataFrame operators.

Every public function takes and returns DataFrames (or Columns); the work is
declared with the DataFrame API so Catalyst plans it and the executors run it.
"""

__version__ = "0.1.0"
