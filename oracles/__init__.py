"""Independent SQL statements of the registered queries."""

from oracles.measures import DASHBOARD, MEASURES
from oracles.rest import ALERTING, ERP, QUALITY, SECURITY, SOURCES
from oracles.streaming import STREAMING
from oracles.views import VIEWS

ORACLES = {**VIEWS, **MEASURES, **DASHBOARD, **ERP, **SECURITY, **QUALITY, **SOURCES, **ALERTING, **STREAMING}
