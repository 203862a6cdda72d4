"""Change-log replication and business views on Spark DataFrames."""
