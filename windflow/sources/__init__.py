"""Sources and sinks: topic logs, brokers, relational tables, change records, metric text."""
