"""Operators for preparing training data at scale (see README "Training-data
operators").  Nothing else in the library imports this subpackage."""
