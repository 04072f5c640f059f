"""quitanda — retail order marts as lazy Spark DataFrame plans.

Layers: raw tables (``sources``) → staging views → intermediate order-grain
roll-ups → conformed dimensions and facts → analytics marts (``plans``), with
declarative data-quality checks (``operators.quality``) gating each layer.
"""

from quitanda.session import get_session, scratch_path
from quitanda.plans.models import Warehouse

__all__ = ["get_session", "scratch_path", "Warehouse"]
