"""DataFrame operators: every one maps DataFrames to a lazy DataFrame unless noted."""
