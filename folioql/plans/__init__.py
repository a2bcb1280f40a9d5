"""SQL statements over document tables: parsing, and planning as DataFrames."""
