"""DataFrame -> DataFrame operators, parameterised by keys and columns."""
