"""End-to-end plans over the driver tables, the query registry and its SQL oracle."""
