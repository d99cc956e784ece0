"""Plan helpers: staging tables between jobs, skew-safe building blocks."""
