"""Column -> Column building blocks; none of them starts a job or a shuffle."""
