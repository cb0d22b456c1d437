"""Importing this package registers every query."""

from importlib import import_module

from vacantia.workloads.base import CHECKS, QUERIES

for _module in (
    "url_jobs",
    "document_jobs",
    "history_jobs",
    "answer_jobs",
    "board_jobs",
    "source_jobs",
):
    import_module(f"vacantia.workloads.{_module}")

__all__ = ["CHECKS", "QUERIES"]
