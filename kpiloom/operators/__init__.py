"""Model-level operators: DataFrame -> DataFrame functions, one per model family."""
