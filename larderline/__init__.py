"""Order, inventory and courier analytics on Spark DataFrames."""
