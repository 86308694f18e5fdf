"""Operators for preparing training data at scale.

Nothing else in the library imports this subpackage.  Each module holds one
operator with a general interface and the thin ``opN_*`` query over it.
"""
