"""Operators for preparing training text: one module per operator, the
registered queries in ``queries``. Nothing else in the library imports this."""
