"""tidemill: data-preparation operators and jobs written for Spark DataFrames."""
