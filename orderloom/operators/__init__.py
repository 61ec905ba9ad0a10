"""The data products: DataFrame in, DataFrame out."""
