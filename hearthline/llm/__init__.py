"""Operators for preparing training data from public-record text. Nothing else in the library imports this subpackage."""
