"""Training-data operators over ``documents`` and ``pages``: one module per operator, plus their queries.

Nothing else in the package imports this subpackage. ``queries.QUERIES`` and
``queries.ORACLE`` hold what the driver entry point registers.
"""
