"""DataFrame -> DataFrame operators, one module per lifecycle step."""
