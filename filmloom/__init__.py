"""filmloom: building and keeping clean large catalogs out of landed web pages, on Spark DataFrames."""
