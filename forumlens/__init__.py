"""Analytics over question-and-answer forum posts, as Spark DataFrames."""
