"""Report builders and the registered queries over the shared test tables."""
