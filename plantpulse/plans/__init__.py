"""Dashboard reads and the catalogue of registered queries."""
