"""Composed plans: generation, and the derived tables later steps use."""
