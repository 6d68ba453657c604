"""DataFrame -> DataFrame operators and fitted transformers."""
