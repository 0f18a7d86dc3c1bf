"""spark-submit entry point for the command line (spark-submit runs a file,
not a module): ``spark-submit --py-files evstar.zip run_evstar.py <command> ...``."""

import sys

from evstar.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
