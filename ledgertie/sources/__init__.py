"""Feed schemas, loading with boundary checks, and bindings of test tables to the feeds."""
