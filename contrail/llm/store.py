"""Tables written to the shared checkpoint folder."""

from contrail.session import stored  # noqa: F401
