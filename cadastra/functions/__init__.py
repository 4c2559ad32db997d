"""Column-level building blocks: lenient codes and labels, CNPJ identifiers, name cleaning, slugs."""
