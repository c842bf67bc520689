"""A log warehouse on Spark: JSON-lines logs in, facts, catalogs and reports out."""
