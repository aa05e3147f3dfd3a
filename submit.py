"""Script for spark-submit; see ``python submit.py --help``."""

import sys

from tidegate.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
