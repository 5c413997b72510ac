"""Flows over file streams."""

from .files import run_new_files

__all__ = ["run_new_files"]
