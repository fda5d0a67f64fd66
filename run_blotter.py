"""Launcher for spark-submit: ``spark-submit run_blotter.py <command> ...``."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from blotter.__main__ import main  # noqa: E402

if __name__ == "__main__":
    main()
