import sys

from kpiloom.cli import main

sys.exit(main())
