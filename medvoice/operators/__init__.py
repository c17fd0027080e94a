"""DataFrame -> DataFrame operators: cleaning, profiling, text, sampling, models."""
