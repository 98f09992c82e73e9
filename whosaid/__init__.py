"""Who said what, and where: quotation analytics on Spark DataFrames."""
