"""Daily class-performance analytics over school records, as PySpark jobs."""
