"""Column expressions."""

from .columns import *  # noqa: F403
