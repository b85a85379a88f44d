"""roamdex: crawled pages and encyclopedia dumps to a searchable document table, on Spark DataFrames."""
