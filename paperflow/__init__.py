"""paperflow: Spark-native jobs over scholarly paper metadata.

Every public function takes and returns DataFrames; nothing is collected to the
driver except bounded, size-checked dimensions (see ``operators.taxonomy``).
"""

__version__ = "0.1.0"
