"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  ``queries`` holds the thin
``opN_*`` queries; each operator module keeps its own general interface.
"""
