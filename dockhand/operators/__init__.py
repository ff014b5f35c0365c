"""DataFrame operators: conform, merge, keyed snapshots, batching, chunked
tables, retention and quality checks."""
