"""What can go wrong, by kind."""

from __future__ import annotations


class EngineError(Exception):
    """Any error of this package."""


class TypeStringError(EngineError, ValueError):
    """A type string that cannot be read."""


class SchemaMismatchError(EngineError):
    """A result that does not have the columns its caller declared."""


class CodecError(EngineError, ValueError):
    """Bytes that are no valid block, frame or column."""


class ChecksumError(CodecError):
    """A frame whose checksum does not agree with its content."""


class TruncatedError(CodecError, EOFError):
    """Bytes that end too early."""


class DrainOverflowError(EngineError):
    """More rows than the array they should go to has room for."""


class SettingError(EngineError):
    """An important setting that the session does not know."""


class QueryError(EngineError):
    """A query that Spark refused or that failed: condition, SQL state and message; the cause is kept."""

    def __init__(self, message: str, condition: str = "", sql_state: str = ""):
        super().__init__(message)
        self.condition, self.sql_state = condition, sql_state
