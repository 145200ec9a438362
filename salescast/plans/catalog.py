"""Import every query module so that its queries register themselves."""

from salescast.plans import q_features  # noqa: F401
from salescast.plans import q_analysis  # noqa: F401
from salescast.plans import q_clean  # noqa: F401
from salescast.plans import q_more  # noqa: F401
from salescast.plans import q_ml  # noqa: F401
from salescast.plans import q_sources  # noqa: F401
