"""Operators for preparing text corpora for training, one module each, and
their registered queries (``queries``). Nothing else in the library imports
this subpackage."""
