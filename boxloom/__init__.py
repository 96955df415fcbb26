"""boxloom: constraint analytics and corpus construction on Spark DataFrames."""
