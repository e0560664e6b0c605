"""Price-dispersion analytics on Spark: from raw daily price lists to basket indices."""
