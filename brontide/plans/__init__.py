"""Model graph, evaluation and registered queries."""
