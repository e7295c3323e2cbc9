"""roomrate: listing-price analytics expressed as Spark DataFrame operators.

Every public function takes and returns DataFrames (or fitted MLlib models).
Nothing row-sized is collected to the driver: only vocabularies, fitted
models, one-row moments and per-group metric rows ever leave the executors.
"""

__version__ = "0.1.0"
