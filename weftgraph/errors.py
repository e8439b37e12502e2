"""Errors raised by the jobs, always before any graph data is written."""


class LoadError(Exception):
    """Base of every error a job raises on purpose."""


class MissingColumnError(LoadError):
    """A named key column is not in the source (exact case)."""


class ReservedColumnError(LoadError):
    """The source uses a column name the graph tables need."""


class UnsupportedTypeError(LoadError):
    """A column's type cannot become a property."""


class NotRegisteredError(LoadError):
    """A label or property was not registered by an init job."""


class TypeConflictError(LoadError):
    """A column's type differs from the registered property type."""


class NameConflictError(LoadError):
    """A label has a column whose name differs from the source's in case only."""


class UnresolvedEndpointError(LoadError):
    """Some edge keys lead to no vertex and ``on_missing`` is ``error``."""
