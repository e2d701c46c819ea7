from kasir.operators.dims import check_unique, join_dim  # noqa: F401
from kasir.operators.previous import with_previous  # noqa: F401
from kasir.operators.quality import (  # noqa: F401
    null_profile, unmatched_keys)
from kasir.operators.sinks import publish, write  # noqa: F401
