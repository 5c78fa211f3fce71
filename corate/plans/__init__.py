"""End-to-end recommenders and the registered queries."""
