"""The registered queries: views over the test tables, Spark queries and their SQL."""
