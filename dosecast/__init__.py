"""Trial-drug supply planning on Spark DataFrames."""
