"""Record linkage and geospatial triage on Spark."""
