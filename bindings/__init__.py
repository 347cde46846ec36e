"""Every operator bound to the test tables, with the SQL that must give the same rows."""

from bindings import calendar, checks, claims, relational, sources, streams  # noqa: F401
from bindings.base import ORACLE, QUERIES  # noqa: F401
