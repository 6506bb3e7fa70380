"""Names, literal coercion, partition transforms and type normalisation."""
