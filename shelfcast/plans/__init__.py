"""Jobs composed from the operators: Silver, Gold, baselines, diagnostics, pipeline."""
