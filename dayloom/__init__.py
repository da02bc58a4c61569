"""dayloom: day-grain analytical marts on Spark DataFrames."""
