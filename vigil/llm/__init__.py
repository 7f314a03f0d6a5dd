"""Training-data pipeline operators.

One module per operator, plus three helpers: :mod:`vigil.llm.tokens`
(vectorised tokenising and rolling hashes over Arrow text columns),
:mod:`vigil.llm.frames` (column handling and frozen tables) and
:mod:`vigil.llm.graph` (connected components).  Nothing else in the library
imports this subpackage.
"""
