"""Query registrations, one module per analysis family."""

from cohortium.entries import activity, cleaning, customer, dedupe, subscriptions  # noqa: F401
