"""Readers: schema contracts, delivery manifests, archives, contracted
delimited text, contracted ORC and JDBC targets."""
