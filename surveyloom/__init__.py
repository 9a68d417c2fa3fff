"""Survey-microdata analytics on Spark: roll-ups, audited joins, profiling,
feature ranking, imbalanced classification and threshold evaluation."""
