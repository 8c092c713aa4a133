"""Operators for building training corpora. Nothing else in factlake imports this subpackage."""
