"""Import every query module so each registers its queries."""

from scribal.plans import q_clean  # noqa: F401
from scribal.plans import q_collate  # noqa: F401
from scribal.plans import q_lookups  # noqa: F401
from scribal.plans import q_resolve  # noqa: F401
from scribal.plans import q_split_reconcile  # noqa: F401
from scribal.plans import q_tree  # noqa: F401
from scribal.plans import q_ingest  # noqa: F401
from scribal.plans import q_roundtrip  # noqa: F401
from scribal.plans import q_stages  # noqa: F401
