"""Column builders: metrics, dates and scalar rules."""
