"""DataFrame -> DataFrame operators, one module per operator family."""
