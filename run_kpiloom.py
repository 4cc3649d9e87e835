"""Launcher for ``spark-submit`` (same as ``python -m kpiloom``).

Only the driver imports kpiloom: every operator is DataFrame API, with no
Python UDF, so executors run JVM code only and need no Python package.
"""

import sys

from kpiloom.cli import main

if __name__ == "__main__":
    sys.exit(main())
