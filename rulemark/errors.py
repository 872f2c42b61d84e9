"""Errors raised by the library."""


class RulemarkError(Exception):
    """Base class."""


class SettingsError(RulemarkError):
    """Paths, columns or options that cannot work."""


class RuleError(RulemarkError):
    """A rule dictionary that cannot be compiled."""
