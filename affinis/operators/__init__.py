"""Table-to-table operators: DataFrames and parameters in, DataFrame out."""
