"""Operators of a training-data pipeline: deduplication, joins, classifiers, packing,
tokenisation and output. Nothing else in the package imports this subpackage."""
