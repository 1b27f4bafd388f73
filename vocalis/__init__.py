"""Opinion analytics over public comments and headlines, built on PySpark DataFrames."""
