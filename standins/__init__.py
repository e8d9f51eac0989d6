"""Queries of the operator check: every operator run over whole test tables, with its SQL twin.

The catalogs the operators are made for are not among the test tables, so each query first maps
tables to the operator's input (``frames``) and then calls the library.
"""
