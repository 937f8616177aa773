"""grainfield: document-field extraction, validation and evaluation on Spark DataFrames."""
