"""Read plans and write schemas: what a file's columns become, told from the schema alone."""
