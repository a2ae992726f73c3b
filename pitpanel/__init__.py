"""pitpanel: point-in-time equity factor panels on Spark DataFrames."""

from pitpanel.config import DEFAULT, PanelConfig  # noqa: F401
