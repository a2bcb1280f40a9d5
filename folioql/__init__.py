"""Document analytics on Spark: schemaless JSON documents as tables, planned and run by Catalyst."""
