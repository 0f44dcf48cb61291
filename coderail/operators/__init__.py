"""DataFrame -> DataFrame operators. Each is a declarative plan; Catalyst picks the physical strategy."""
