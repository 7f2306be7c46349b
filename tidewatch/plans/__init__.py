"""The five streaming patterns and the registered queries."""
