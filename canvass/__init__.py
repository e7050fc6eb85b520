"""Field-survey audit and monitoring on Spark DataFrames."""
