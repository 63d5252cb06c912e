from scorecast.sources.tables import TABLES, load_table  # noqa: F401
from scorecast.sources.views import (  # noqa: F401
    activity, helpfulness, reviews, shipments, vectors,
)
