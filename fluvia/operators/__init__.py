"""Landing, merging, reshaping, collapsing: DataFrame in, DataFrame out."""
