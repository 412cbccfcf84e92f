"""framewright: building and auditing region-annotation datasets on Spark."""
