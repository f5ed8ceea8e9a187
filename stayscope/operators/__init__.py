"""DataFrame operators: cohort, events, stats, report, metrics, sampling,
model and explain."""
