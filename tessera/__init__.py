"""tessera: one customer profile out of four sales channels, as Spark DataFrames."""
