"""Launcher for spark-submit:  spark-submit spokes_refresh.py refresh --landing <dir> --root <dir>"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from spokes.cli import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
