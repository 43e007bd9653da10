"""Operators for preparing training corpora (documents, pages, labels, benchmark).

One module per operator, each with a general interface on DataFrames;
``queries.py`` binds them to the driver tables. Nothing outside this
subpackage imports it.

Conventions shared by all operators:

* a null text is the empty text; a null ``doc_id`` ranks after every other id;
* rows that repeat a ``doc_id`` are separate rows of the same document rank;
* other columns of the input never reach an operator, so names cannot clash;
* intermediate tables go through ``common.keep`` (a reliable checkpoint in the
  shared folder), never to a machine-local folder.
"""
