"""Operators for preparing training text: decontamination, near-duplicate join,
personal data, licences, quality, language, tokens, toxicity and packing."""
