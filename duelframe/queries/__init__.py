"""Registered queries; importing the package registers all of them."""

from duelframe.queries import jobs, library, round_trips, whole_jobs  # noqa: F401
