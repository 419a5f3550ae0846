"""The phase job and the registered queries."""
