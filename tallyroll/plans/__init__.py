"""The jobs: validation, Silver, Gold, the mart, reports, profiling and the full run."""
