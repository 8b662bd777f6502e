"""Operators for preparing training text: tokenizing, fingerprints, duplicates, language,
toxicity, personal data.  Nothing else in the library imports this subpackage."""
