"""factlake: a PySpark engine for versioned fact tables."""
