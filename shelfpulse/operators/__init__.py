"""Product signals, scores and list filters: DataFrame in, DataFrame out."""
