"""Operators of a training-data pipeline over text corpora and embeddings.

Nothing else in the library imports this subpackage.  Conventions shared by
every operator here:

* input is a DataFrame plus the names of its id and text columns; all other
  columns are ignored, whatever their names, and never reach a shuffle;
* a null text counts as the empty text;
* an empty table gives an empty result with the documented columns.
"""
