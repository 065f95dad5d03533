"""Order-preserving, linkage, merge and validation operators over DataFrames."""
