"""farelake: a bronze / silver / gold lakehouse for trip records, expressed as Spark DataFrames."""
