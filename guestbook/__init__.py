"""Review analytics on Spark: lazy ``DataFrame -> DataFrame`` operators over large tables of customer reviews."""
