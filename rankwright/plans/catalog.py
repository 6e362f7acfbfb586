"""All registered queries; importing the family modules fills the registry."""

from __future__ import annotations

from . import click_queries  # noqa: F401
from .click_queries import entry_query  # noqa: F401
from .registry import ORACLE, QUERIES  # noqa: F401
from . import grouping_queries  # noqa: F401,E402
from . import label_queries  # noqa: F401,E402
from . import retrieval_queries  # noqa: F401,E402
from . import feature_queries  # noqa: F401,E402
from . import field_queries  # noqa: F401,E402
from . import training_queries  # noqa: F401,E402
from . import stream_queries  # noqa: F401,E402
from . import ranker_queries  # noqa: F401,E402
