"""Panel analytics on Spark: canonical schemas, a yearly Parquet lake, entity-year panels,
descriptive reports, clustering and risk models, all as DataFrame-to-DataFrame functions."""
