"""DataFrame operators: staging, dimension, fact, marts, data quality."""
