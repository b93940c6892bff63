"""millrace: data preparation, feature building and modelling jobs on Spark DataFrames."""
