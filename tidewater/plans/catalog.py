"""Imports every query module so that its entries register."""

from tidewater.plans import flagship  # noqa: F401
from tidewater.plans import q_traffic  # noqa: F401
from tidewater.plans import q_windows  # noqa: F401
from tidewater.plans import q_reports  # noqa: F401
from tidewater.plans import q_functions  # noqa: F401
from tidewater.plans import q_prep  # noqa: F401
from tidewater.plans import q_models  # noqa: F401
from tidewater.plans import q_sources  # noqa: F401
from tidewater.plans import q_stream  # noqa: F401
from tidewater.plans import q_ml  # noqa: F401
