"""Operators for large text corpora: filtering, matching, labelling and sampling."""
