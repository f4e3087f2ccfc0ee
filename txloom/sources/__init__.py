"""Reading inputs, writing results, and the chain tables derived from the sample data."""
