"""Operators of a training-data pipeline: de-duplication, mixing, token
counts, quality and safety classifiers, personal data, language-model scoring
and decontamination. Nothing else in the library imports this subpackage."""
