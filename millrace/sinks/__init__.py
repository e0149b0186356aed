"""Write semantics: partition replace, keyed merge, audited export."""
