"""vellum: text knowledge-graph analytics expressed as Spark DataFrames."""
