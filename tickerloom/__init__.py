"""tickerloom: equity-market analytics as Spark jobs (see README.md)."""
