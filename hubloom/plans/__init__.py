"""The request paths as whole jobs, and the registered queries."""
