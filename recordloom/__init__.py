"""recordloom: registry reconciliation and record linkage on Spark DataFrames."""
