"""Survey operators over DataFrames."""
