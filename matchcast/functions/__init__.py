"""Column expressions: odds, target encoding, derived features, hashed uniforms."""
