"""Cost allocation on Spark: ledger lines -> towers -> applications -> business units."""

__version__ = "0.1.0"
