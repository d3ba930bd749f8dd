"""featloom: tabular features, training sets, model training and batch scoring on Spark DataFrames."""
