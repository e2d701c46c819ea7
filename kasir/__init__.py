"""kasir: Spark-native retail sales analytics.

Sub-packages:
  functions  - scalar column expressions and ingest casts (built-ins only)
  sources    - table readers, report-file reader, test fixtures
  operators  - reusable DataFrame -> DataFrame building blocks
  plans      - the sales, monthly, cohort, tracker and menu jobs; pipelines
"""

from kasir.config import DEFAULT, Config  # noqa: F401
